"""Physical-plan checks for the scale-relevant choices."""

from pyspark.sql import functions as F

from paysight.operators.quantiles import _histogram_state, _prepare
from paysight.operators.rare import group_rare
from paysight.operators.sample import hash_sample

SF_SMALL = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_rare_join_broadcast_only_within_bound(spark):
    rows = [("DE",)] * 50 + [("FR",)] * 2 + [("IS",)]
    df = spark.createDataFrame(rows, "Country string").repartition(3)
    # switch off the planner's own size-based broadcast to see our decision alone
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in _plan(group_rare(df, "Country", 3))
        beyond = _plan(group_rare(df, "Country", 3, max_broadcast_rows=0))
        assert "SortMergeJoin" in beyond and "BroadcastHashJoin" not in beyond
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hash_sample_filters_before_ordered_limit(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    plan = _plan(hash_sample(df, "k", 100))
    assert "TakeOrderedAndProject" in plan
    assert "conv(substring(md5" in plan  # digest-prefix filter below the ordered limit


def test_exact_first_round_is_a_mergeable_histogram(spark):
    df = spark.range(5000).select((F.col("id") % 13).alias("g"), F.col("id").cast("double").alias("x"))
    base, keys = _prepare(df, "x", ["g"])
    state_df, contiguous, held = _histogram_state(base, keys, [0.5])
    assert contiguous
    # the bracket table came from counts per (group, bin): no sketch aggregate anywhere
    assert "percentile" not in state_df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert state_df.count() == 13
    held.release()


def test_silver_on_bronze_prunes_and_pushes(spark, tmp_dir):
    import os

    from paysight.plans.silver import SilverParams, fit_silver
    from paysight.sources.files import read_bronze, write_bronze
    from paysight.sources.tables import survey_view


    path = os.path.join(tmp_dir, "bronze")
    write_bronze(survey_view(spark, SF_SMALL).withColumn("Extra", F.lit("x")), path)
    bronze = read_bronze(spark, path, years=[1996, 1997])
    model = fit_silver(bronze, SilverParams(rel_error=0.0, min_country=5))
    plan = _formatted(model.transform(bronze))
    # trim bounds and null checks reach the Parquet scan, years are pruned
    assert "IsNotNull(ConvertedCompYearly)" in plan
    assert "GreaterThanOrEqual(ConvertedCompYearly," in plan and "LessThanOrEqual(ConvertedCompYearly," in plan
    assert "PartitionFilters: [SurveyYear" in plan
    read_schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema:")]
    assert read_schemas and all("Extra" not in line for line in read_schemas)
