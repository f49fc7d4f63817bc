import math
import random

import pytest
from pyspark.sql import functions as F

from paysight.operators.quantiles import approx_quantiles, exact_quantiles, quantile_values
from paysight.operators.trim import fit_medians, impute_median, trim_quantiles

PROBS = [0.0, 0.01, 0.07, 0.25, 0.29, 0.5, 0.75, 0.99, 1.0]


def _data(spark, n=2000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        g = rnd.choice(["a", "b", "c", None])
        x = None if rnd.random() < 0.05 else float(rnd.randint(0, 400)) / 4
        rows.append((g, x))
    return spark.createDataFrame(rows, "g string, x double")


def _disc(df, probs, by):
    aggs = [F.expr(f"percentile_disc({p}) within group (order by x)").alias(f"q{i}") for i, p in enumerate(probs)]
    rows = df.groupBy(*by).agg(*aggs).collect()
    return {tuple(r[b] for b in by): [r[f"q{i}"] for i in range(len(probs))] for r in rows}


@pytest.mark.parametrize("max_candidates", [2_000_000, 40, 2])
def test_exact_matches_percentile_disc(spark, max_candidates):
    df = _data(spark)
    got = exact_quantiles(df, "x", PROBS, by=["g"], max_candidates=max_candidates).collect()
    got = {(r["g"],): [r[f"q{i}"] for i in range(len(PROBS))] for r in got}
    assert got == _disc(df, PROBS, ["g"])


def test_exact_global_and_rank_rule(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    assert quantile_values(df, "x", [0.5], 0.0) == [2.0]
    assert quantile_values(df, "x", [0.25, 0.75, 1.0], 0.0) == [1.0, 3.0, 4.0]


def test_all_equal_values_resolve_without_window(spark):
    df = spark.range(500).select(F.lit(3.5).alias("x"))
    assert quantile_values(df, "x", [0.1, 0.9], 0.0) == [3.5, 3.5]


def test_nan_and_null_ignored(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (5.0,), (3.0,)], "x double")
    assert quantile_values(df, "x", [0.5], 0.0) == [3.0]


def test_empty_input(spark):
    df = spark.createDataFrame([], "x double")
    assert quantile_values(df, "x", [0.5], 0.0) is None
    assert quantile_values(df, "x", [0.5], 0.01) is None
    # trimming an empty frame leaves it as it is (no unpack error)
    assert trim_quantiles(df.withColumnRenamed("x", "ConvertedCompYearly")).count() == 0


def test_sketch_rank_error_bounded(spark):
    n = 20000
    df = spark.range(n).select((F.col("id") * 7 % n).cast("double").alias("x"))
    got = approx_quantiles(df, "x", [0.1, 0.5, 0.9], rel_error=0.001).first()
    for i, p in enumerate([0.1, 0.5, 0.9]):
        exact = math.ceil(p * n) - 1
        assert abs(got[f"q{i}"] - exact) <= 0.001 * n + 1


def test_trim_keeps_closed_range(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("ConvertedCompYearly"))
    out = trim_quantiles(df, lower=0.01, upper=0.99, rel_error=0.0)
    assert out.count() == 99  # q01 = 1, q99 = 99, both kept
    assert trim_quantiles(out, lower=0.0, upper=1.0, rel_error=0.0).count() == 99


def test_impute_median(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None), (10.0, None)], "a double, b double")
    assert fit_medians(df, ["a", "b"], 0.0) == {"a": 3.0}
    out = impute_median(df, ["a", "b"], 0.0).orderBy(F.col("a").asc_nulls_first()).collect()
    assert [r["a_imp"] for r in out] == [3.0, 1.0, 3.0, 10.0]
    assert all(r["b_imp"] is None for r in out)  # all-null column is left null, no error


def test_extreme_and_signed_values(spark):
    vals = [-float("inf"), -1e300, -5.0, -0.0, 0.0, 1e-300, 2.5, 3.0, 3.0, 1e12, 1e300, float("inf")]
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b"]), v) for v in vals for _ in range(rnd.randint(1, 40))]
    df = spark.createDataFrame(rows, "g string, x double")
    got = exact_quantiles(df, "x", PROBS, by=["g"], max_candidates=5).collect()
    got = {(r["g"],): [r[f"q{i}"] for i in range(len(PROBS))] for r in got}
    assert got == _disc(df, PROBS, ["g"])


def test_non_contiguous_bins_fall_back_to_counting(spark, monkeypatch):
    import paysight.operators.quantiles as q

    # a deliberately non-monotone binning: results must stay exact
    monkeypatch.setattr(q, "_log_bin", lambda x: (F.abs(F.hash(x)) % 7).cast("int"))
    df = _data(spark, n=800, seed=11)
    got = exact_quantiles(df, "x", PROBS, by=["g"]).collect()
    got = {(r["g"],): [r[f"q{i}"] for i in range(len(PROBS))] for r in got}
    assert got == _disc(df, PROBS, ["g"])


def test_hot_group_exact(spark):
    # one key holds most rows; brackets are refined until small
    rows = [("hot", float(i % 997)) for i in range(6000)] + [("cold", float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = exact_quantiles(df, "x", [0.5, 0.9], by=["g"], max_candidates=50).collect()
    got = {(r["g"],): [r["q0"], r["q1"]] for r in got}
    assert got == _disc(df, [0.5, 0.9], ["g"])


def test_histogram_method_rank_error_bounded(spark):
    n_per = 3000
    rows = [(g, float((i * 7919) % 10007) + g) for g in range(3) for i in range(n_per)]
    df = spark.createDataFrame(rows, "g int, x double")
    probs = [0.1, 0.5, 0.9]
    for err in (0.001, 0.05):
        got = approx_quantiles(df, "x", probs, by=["g"], rel_error=err, method="histogram").collect()
        for r in got:
            xs = sorted(x for g, x in rows if g == r["g"])
            for i, p in enumerate(probs):
                k = max(1, math.ceil(p * n_per))
                v = r[f"q{i}"]
                assert v in xs
                lo_rank = xs.index(v) + 1
                hi_rank = len(xs) - xs[::-1].index(v)
                assert lo_rank - err * n_per <= k + 1e-9 and k <= hi_rank + err * n_per + 1e-9
    with pytest.raises(ValueError):
        approx_quantiles(df, "x", probs, method="nope")
