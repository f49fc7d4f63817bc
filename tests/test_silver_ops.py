import pytest
from pyspark.sql import functions as F

from paysight.operators.filters import drop_any_null, population_filter, positive, role_pattern
from paysight.operators.rare import group_rare
from paysight.operators.text import fill_text, split_tokens
from paysight.operators.union import union_by_name
from paysight.plans.silver import SilverParams, fit_silver, silver
from paysight.schema import align_to_schema, require_columns, select_available, select_strict


def _people(spark):
    rows = [
        ("I am a developer by profession", "Employed, full-time", "Developer, back-end", 100.0),
        ("I am a developer by profession", "Not employed, but looking", "DevOps specialist", 200.0),
        ("I code sometimes", "Employed", "Developer", 300.0),
        (None, "Employed", "Developer", 400.0),
        ("Developer", "employed", None, 500.0),
        ("developer", "EMPLOYED", "SRE lead", None),
        ("developer", "employed", "Marketing", 600.0),
        ("DEVELOPER", "self-employed", "Senior Data Scientist", 700.0),
    ]
    return spark.createDataFrame(rows, "MainBranch string, Employment string, DevType string, ConvertedCompYearly double")


def test_population_null_logic(spark):
    out = population_filter(_people(spark)).collect()
    assert sorted(r["ConvertedCompYearly"] for r in out) == [100.0, 200.0, 700.0]


def test_population_options(spark):
    df = _people(spark)
    strict = population_filter(df, exclude_employment="not employed").collect()
    assert sorted(r["ConvertedCompYearly"] for r in strict) == [100.0, 700.0]
    assert role_pattern(["sre"], word_boundary=True) == "(?i)\\b(sre)\\b"


def test_population_skips_absent_columns(spark):
    df = _people(spark).drop("DevType", "MainBranch")
    assert population_filter(df).count() == 7  # only the null-salary row goes


def test_positive_and_dropna(spark):
    df = spark.createDataFrame([(1.0, "a"), (0.0, "b"), (None, "c"), (-2.0, None)], "ConvertedCompYearly double, t string")
    assert positive(df).count() == 1
    assert drop_any_null(df, ["ConvertedCompYearly", "t"]).count() == 2


@pytest.mark.parametrize("max_broadcast_rows", [1_000_000, 0])
def test_group_rare(spark, max_broadcast_rows):
    rows = [("DE",)] * 5 + [("FR",)] * 2 + [("IS",)] + [(None,)]
    df = spark.createDataFrame(rows, "Country string")
    out = group_rare(df, "Country", 3, max_broadcast_rows=max_broadcast_rows)
    got = sorted((r["Country"] or "", r["CountryGrouped"] or "") for r in out.collect())
    assert got == sorted([("DE", "DE")] * 5 + [("FR", "Other")] * 2 + [("IS", "Other"), ("", "")])


def test_group_rare_none_rare(spark):
    df = spark.createDataFrame([("DE",)] * 4 + [(None,)], "Country string")
    out = group_rare(df, "Country", 1)
    assert out.where(~F.col("CountryGrouped").eqNullSafe(F.col("Country"))).count() == 0
    assert "CountryGrouped" in out.columns


def test_fill_and_tokens(spark):
    df = spark.createDataFrame([("Python;C#;;Bash/Shell",), ("",), (None,)], "LanguageHaveWorkedWith string")
    filled = fill_text(df, ["LanguageHaveWorkedWith"])
    toks = [r["t"] for r in filled.select(split_tokens("LanguageHaveWorkedWith").alias("t")).collect()]
    assert toks == [["python", "c#", "bash/shell"], [], ["none"]]
    both = fill_text(df, ["LanguageHaveWorkedWith"], empty_too=True).collect()
    assert [r[0] for r in both] == ["Python;C#;;Bash/Shell", "None", "None"]


def test_union_null_fill_and_strict(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([(2,)], "k int")
    c = spark.createDataFrame([("z", 3)], "s string, k int")
    out = union_by_name([a, b, c]).orderBy("k").collect()
    assert [(r["k"], r["s"]) for r in out] == [(1, "x"), (2, None), (3, "z")]
    with pytest.raises(Exception):
        union_by_name([a, b], allow_missing=False).collect()
    left = union_by_name([union_by_name([a, c]), a]).orderBy("k").collect()
    right = union_by_name([a, union_by_name([c, a])]).orderBy("k").collect()
    assert left == right


def test_schema_helpers(spark):
    df = spark.createDataFrame([("1", "5")], "ResponseId string, ConvertedCompYearly string")
    aligned = align_to_schema(df)
    assert dict(aligned.dtypes)["ConvertedCompYearly"] == "double"
    assert aligned.first()["Country"] is None
    assert select_available(df, ["nope", "ResponseId"]).columns == ["ResponseId"]
    with pytest.raises(ValueError):
        select_strict(df, ["nope"])
    with pytest.raises(ValueError):
        require_columns(df, ["features"])


def test_silver_fit_replays_on_new_rows(spark):
    rows = []
    for i in range(400):
        rows.append(
            (
                i,
                "I am a developer by profession",
                "Employed, full-time",
                "Developer, back-end",
                float(1000 + i),
                "DE" if i % 4 else "IS" if i % 8 == 0 else "FR",
                str(i % 30) if i % 7 else None,
                "25-34 years old",
                None if i % 5 == 0 else "Python;SQL",
            )
        )
    schema = (
        "ResponseId int, MainBranch string, Employment string, DevType string, ConvertedCompYearly double, "
        "Country string, YearsCodePro string, Age string, LanguageHaveWorkedWith string"
    )
    df = spark.createDataFrame(rows, schema)
    model = fit_silver(df, SilverParams(rel_error=0.0, min_country=60))
    assert model.bounds.lo == 1003.0 and model.bounds.hi == 1395.0
    out = model.transform(df)
    assert out.count() == 393
    assert out.where(F.col("YearsCodeProNum_imp").isNull()).count() == 0
    assert out.where(F.col("LanguageHaveWorkedWith").isNull()).count() == 0
    assert {r[0] for r in out.select("CountryGrouped").distinct().collect()} == {"DE", "Other"}
    assert silver(df, SilverParams(rel_error=0.0, min_country=60)).count() == 393
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan


def test_join_choices(spark):
    from pyspark.sql import functions as F

    from paysight.operators.text import join_choices

    df = spark.createDataFrame([(["Python", "SQL"], 1.0), ([], None)], "langs array<string>, y double")
    got = [r[0] for r in df.select(join_choices(F.col("langs"))).collect()]
    assert got == ["Python;SQL", ""]
