"""Driver tables and the survey-shaped view derived from them.

``survey_view`` builds one survey row per order (orders x customer x
nation) with deterministic missing values and free-text answers, so every
operator can be exercised on data that grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paysight.runtime import ensure_parallelism, maybe_broadcast

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def load_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A driver table. With ``spread`` an input with fewer splits than
    cores is spread out first (see :func:`paysight.runtime.ensure_parallelism`);
    worth it only ahead of CPU-heavy row work."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return ensure_parallelism(df) if spread else df


def _mod(c: Column, m: int) -> Column:
    return c % F.lit(m)


def survey_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey rows derived from ``orders``, ``customer`` and ``nation``.

    ``nation`` is broadcast after its row count is checked; the
    orders-customer join is left to the planner (sort-merge with AQE skew
    handling at scale, broadcast when AQE sees a small side).
    """
    orders = load_table(spark, sf_dir, "orders", spread=True).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = load_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation, _ = maybe_broadcast(load_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), 10_000)
    j = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )
    k, u = F.col("o_orderkey"), F.col("o_custkey")
    null_s = F.lit(None).cast("string")
    null_d = F.lit(None).cast("double")
    # Answer texts of the derived survey view.
    main_branch = (
        F.when(F.col("o_orderstatus") == "F", F.lit("I am a developer by profession"))
        .when(F.col("o_orderstatus") == "P", F.lit("I am not primarily a developer, but I write code"))
        .otherwise(F.lit("I am learning to code"))
    )
    employment = (
        F.when(_mod(u, 4) == 0, F.lit("Student, full-time"))
        .when(_mod(u, 4) == 1, F.lit("Not employed, but looking for work"))
        .otherwise(F.lit("Employed, full-time"))
    )
    pr = F.col("o_orderpriority")
    dev_type = (
        F.when(pr == "1-URGENT", F.lit("Developer, back-end"))
        .when(pr == "2-HIGH", F.lit("DevOps specialist"))
        .when(pr == "3-MEDIUM", F.lit("Data scientist or machine learning specialist"))
        .when(pr == "4-NOT SPECIFIED", null_s)
        .otherwise(F.lit("Marketing or sales professional"))
    )
    k53 = _mod(k, 53)
    years_pro = (
        F.when(k53 == 0, F.lit("Less than 1 year"))
        .when(k53 == 51, F.lit("More than 50 years"))
        .when(k53 == 52, F.lit("NA"))
        .when(_mod(k, 17) == 0, null_s)
        .otherwise(k53.cast("string"))
    )
    u6 = _mod(u, 6)
    age = (
        F.when(u6 == 0, F.lit("Under 18 years old"))
        .when(u6 == 1, F.lit("18-24 years old"))
        .when(u6 == 2, F.lit("25-34 years old"))
        .when(u6 == 3, F.lit("65 years or older"))
        .when(u6 == 4, F.lit("Prefer not to say"))
        .otherwise(null_s)
    )
    k4 = _mod(k, 4)
    remote = (
        F.when(k4 == 0, F.lit("Remote"))
        .when(k4 == 1, F.lit("Hybrid (some remote, some in-person)"))
        .when(k4 == 2, F.lit("In-person"))
        .otherwise(null_s)
    )
    languages = F.when(_mod(k, 23) == 0, null_s).otherwise(
        F.concat_ws(
            ";",
            F.when(_mod(k, 2) == 0, F.lit("Python")),
            F.when(_mod(k, 3) == 0, F.lit("C#")),
            F.when(_mod(k, 5) == 0, F.lit("Bash/Shell")),
            F.when(_mod(k, 211) == 0, F.lit("APL")),
        )
    )
    databases = F.when(_mod(k, 7) == 0, null_s).otherwise(
        F.concat_ws(
            ";",
            F.when(_mod(u, 2) == 0, F.lit("PostgreSQL")),
            F.when(_mod(u, 3) == 0, F.lit("Redis")),
        )
    )
    return j.select(
        k.alias("ResponseId"),
        F.year("o_orderdate").cast("int").alias("SurveyYear"),
        F.col("n_name").alias("Country"),
        F.when(_mod(k, 11) == 0, null_d)
        .when(_mod(k, 97) == 0, F.lit(0.0))
        .otherwise(F.col("o_totalprice"))
        .alias("ConvertedCompYearly"),
        F.when(_mod(k, 13) == 0, null_d)
        .otherwise(F.col("o_totalprice") * (F.lit(1) + _mod(k, 5)))
        .alias("CompTotal"),
        main_branch.alias("MainBranch"),
        employment.alias("Employment"),
        dev_type.alias("DevType"),
        years_pro.alias("YearsCodePro"),
        age.alias("Age"),
        F.col("c_mktsegment").alias("EdLevel"),
        F.when(_mod(k, 19) == 0, null_s).otherwise(pr).alias("OrgSize"),
        remote.alias("RemoteWork"),
        languages.alias("LanguageHaveWorkedWith"),
        databases.alias("DatabaseHaveWorkedWith"),
    )
