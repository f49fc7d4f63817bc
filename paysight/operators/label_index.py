"""Category indices for any number of labels (M1), without a label list on the driver.

The index of a label is its rank by falling count, ties by the label, as ``StringIndexer`` gives it. The ranks come
from a range-partitioned sort of the label counts: rows of a partition are numbered in their order, and the
sizes of the partitions before it are added. No window or task holds all labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paysight.runtime import SmallTable, stage_table

ROW_BITS = 33  # monotonically_increasing_id: partition above, row within it below


def label_ranks(df: DataFrame, col: str) -> DataFrame:
    """(label, n, idx) of every non-null label of ``col`` as text; idx runs from 0.

    An empty column gives an empty table. Labels that differ only in case or blanks are different labels.
    """
    counts = df.select(F.col(col).cast("string").alias("label")).filter("label IS NOT NULL").groupBy("label").agg(F.count("*").alias("n"))
    # written once: the numbering must not be worked out twice
    ordered = stage_table(counts.orderBy(F.desc("n"), "label").withColumn("place", F.monotonically_increasing_id()), "label-ranks")
    part = F.shiftright("place", ROW_BITS)
    row = F.col("place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    # one row per partition of the sort
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = SmallTable(sizes.select("part", before.alias("before")))
    numbered = ordered.select("label", "n", part.alias("part"), row.alias("row")).join(offsets.for_join(), "part")
    return numbered.select("label", "n", (F.col("row") + F.col("before")).alias("idx"))


def index_column(df: DataFrame, col: str, ranks: DataFrame, out: str | None = None) -> DataFrame:
    """``df`` with ``{col}_idx``: the label's rank, or the number of labels for null and unseen values.

    ``ranks`` is joined by broadcast only if it is small; else by a shuffle join, whose hot labels adaptive execution splits.
    """
    table = SmallTable(ranks.select(F.col("label").alias("_label"), F.col("idx").alias("_idx")))
    joined = df.join(table.for_join(), F.col(col).cast("string") == F.col("_label"), "left")
    index = F.coalesce(F.col("_idx"), F.lit(table.rows)).cast("double")
    return joined.withColumn(out or f"{col}_idx", index).drop("_label", "_idx")
