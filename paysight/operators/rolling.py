"""Year profiles kept as mergeable counts while a bronze table grows.

A landing adds, per year, its rows counted by the fixed bins of the quantile selection, with their sums and ends. Such
counts merge by addition, so the profile of any number of landings is a sum over small rows instead of a pass over all
years' data. Rows, nulls and means come from the counts alone; a median needs only the rows of the one
bin of each year that holds its rank, which a filter on year and value finds in the bronze table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paysight.operators.quantiles import BIN_COLUMNS, exact_quantiles, value_bin
from paysight.runtime import maybe_broadcast, stage_table
from paysight.schema import TARGET, YEAR

BATCH = "_batch"
MAX_YEARS = 200  # whose ranges are written out as one filter


def bin_state(df: DataFrame, target: str = TARGET, by: Sequence[str] = (YEAR,)) -> DataFrame:
    """One row per (by, bin): counts, sum and ends of the target; rows without a value (null, NaN) have a null bin."""
    x = F.col(target).cast("double")
    sound = F.when(~F.isnan(x), x)
    count, low, high = (F.count(sound), F.min(sound), F.max(sound))
    return df.groupBy(*by, value_bin(sound).alias(BIN_COLUMNS[0])).agg(
        count.alias(BIN_COLUMNS[1]),
        low.alias(BIN_COLUMNS[2]),
        high.alias(BIN_COLUMNS[3]),
        F.count(F.lit(1)).alias("n_rows"),
        F.count(x).alias("n_not_null"),
        F.sum(x).alias("total"),
    )


def land_state(df: DataFrame, path: str, batch: str, target: str = TARGET, by: Sequence[str] = (YEAR,)) -> None:
    """Add a landing's counts to the state table at ``path``. A batch that is landed again replaces its own counts."""
    rows = bin_state(df, target, by).withColumn(BATCH, F.lit(batch))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)


def merged_state(spark: SparkSession, path: str, by: Sequence[str] = (YEAR,)) -> DataFrame:
    b, c, low, high = BIN_COLUMNS
    return spark.read.parquet(path).groupBy(*by, b).agg(
        F.sum(c).alias(c), F.min(low).alias(low), F.max(high).alias(high), F.sum("n_rows").alias("n_rows"), F.sum("n_not_null").alias("n_not_null"), F.sum("total").alias("total")
    )


def _around_median(state: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, low, high) of the bin that holds the median's rank."""
    b, c, low, high = BIN_COLUMNS
    # at most as many rows per group as there are bins
    window = Window.partitionBy(*by)
    running = F.sum(c).over(window.orderBy(b).rowsBetween(Window.unboundedPreceding, 0))
    ranked = state.filter(F.col(b).isNotNull()).withColumn("upto", running).withColumn("rank", F.ceil(F.sum(c).over(window) * 0.5))
    return ranked.filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col(c) < F.col("rank"))).select(*by, F.col(low).alias("low"), F.col(high).alias("high"))


def _overlaps(state: DataFrame, by: Sequence[str]) -> bool:
    """Whether some bin's values reach into the next one's (rounding could do it): all rows are needed then."""
    b, _, low, high = BIN_COLUMNS
    before = F.lag(high).over(Window.partitionBy(*by).orderBy(b))
    return not state.filter(F.col(b).isNotNull()).withColumn("before", before).filter(F.col("before") >= F.col(low)).isEmpty()


def profile_from_state(state: DataFrame, rows: DataFrame, target: str = TARGET, year: str = YEAR) -> DataFrame:
    """The per-year profile (as ``profile``, exact) of the rows whose counts were merged into ``state``.

    ``rows`` is the bronze table; only the median bins' rows are read, by a filter that reaches the scan.
    """
    state = stage_table(state, "profile-state")  # at most one row per year and bin, read several times
    totals = state.groupBy(year).agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_not_null").alias("n_salary_not_null"),
        (F.sum("n_rows") - F.sum("n_not_null")).alias("n_salary_null"),
        F.try_divide(F.sum("total"), F.sum("n_not_null")).alias("mean_salary"),
    )
    brackets = _around_median(state, [year])
    few = brackets.limit(MAX_YEARS + 1).collect()
    x = F.col(target).cast("double")
    near = rows
    if len(few) <= MAX_YEARS and not _overlaps(state, [year]):
        same = lambda r: F.col(year).isNull() if r[year] is None else F.col(year) == r[year]
        near = rows.where(reduce(lambda a, b: a | b, [same(r) & x.between(r["low"], r["high"]) for r in few], F.lit(False)))
    counts = state.filter(F.col(BIN_COLUMNS[0]).isNotNull()).select(year, *BIN_COLUMNS)
    median = exact_quantiles(near, x, [0.5], by=[year], names=["median_salary"], counts=counts)
    small, _ = maybe_broadcast(median.withColumnRenamed(year, "_y"))
    return totals.join(small, F.col(year).eqNullSafe(F.col("_y")), "left").drop("_y").orderBy(year)


def trend_from_state(state: DataFrame, rows: DataFrame, target: str = TARGET, year: str = YEAR) -> DataFrame:
    """Rows and median target per year (as ``trend``, exact), likewise."""
    return profile_from_state(state, rows, target, year).select(year, F.col("n_rows").alias("n"), "median_salary")
