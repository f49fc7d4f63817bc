"""The command line hands every path on to its job."""

import pytest

from paysight.plans import jobs


@pytest.mark.parametrize(
    "name,argv,want",
    [
        ("silver_job", ["silver", "--bronze", "b", "--out", "o", "--model", "m"], ("b", "o", "m")),
        ("eda_job", ["eda", "--silver", "s", "--out", "o", "--gold", "g", "--models", "lr_v1=a", "gbt_v2=b"], ("s", "o", "g", {"lr_v1": "a", "gbt_v2": "b"})),
        ("eda_job", ["eda", "--silver", "s", "--out", "o"], ("s", "o", None, {})),
        ("score_job", ["score", "--requests", "r", "--pipeline", "p", "--model", "m", "--out", "o", "--silver-model", "f"], ("r", "p", "m", "gbt", "o", "f")),
    ],
)
def test_flags_reach_the_job(spark, monkeypatch, name, argv, want):
    seen = []
    monkeypatch.setattr(jobs, name, lambda _, *args: seen.append(args))
    jobs.main(argv)
    assert tuple(a for a in seen[0] if not isinstance(a, jobs.SilverParams)) == want


def test_models_need_gold():
    with pytest.raises(SystemExit):
        jobs.main(["eda", "--silver", "s", "--out", "o", "--models", "lr_v1=a"])
