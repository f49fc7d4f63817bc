"""Rare-value grouping (J1): values seen fewer than ``min_count`` times
become ``other``.

The per-value counts are partial aggregates (map-side combine, so a value
holding a third of all rows costs one counter per task). Only the rare
values are joined back: each of them has fewer than ``min_count`` rows, so
the joined side is never skewed. It is broadcast when its row count is
within a checked bound and shuffle-joined otherwise; nothing is collected
to the driver. A null value stays null even when the null group is rare.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysight.runtime import DEFAULT_MAX_BROADCAST_ROWS, SmallTable


def rare_values(df: DataFrame, col: str, min_count: int) -> DataFrame:
    """Non-null values of ``col`` with fewer than ``min_count`` rows."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("_rare_n"))
        .where(F.col("_rare_n") < F.lit(min_count))
        .select(F.col(col).alias("_rare_value"))
    )


def kept_values(df: DataFrame, col: str, min_count: int) -> DataFrame:
    """Non-null values of ``col`` with at least ``min_count`` rows: one row per so many input rows at most."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") >= F.lit(min_count)).select(F.col(col).alias("_kept_value"))


def group_rare(
    df: DataFrame,
    col: str = "Country",
    min_count: int = 100,
    out_col: str | None = None,
    other: str = "Other",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Add ``out_col`` (default ``{col}Grouped``): ``other`` for rare values."""
    if col not in df.columns:
        return df
    out_col = out_col or f"{col}Grouped"
    table = SmallTable(rare_values(df, col, min_count).withColumn("_rare_hit", F.lit(True)), max_broadcast_rows)
    if table.rows == 0:
        table.release()
        return df.withColumn(out_col, F.col(col))
    rare = table.for_join()
    joined = df.join(rare, df[col] == rare["_rare_value"], "left")
    return joined.withColumn(
        out_col, F.when(F.col("_rare_hit"), F.lit(other)).otherwise(F.col(col))
    ).drop("_rare_value", "_rare_hit")
