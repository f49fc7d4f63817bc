"""Large multi-line CSV files read by many tasks.

Spark gives a CSV file whose quoted fields span lines to one task. Here files are read as lines, in byte ranges,
and the records are put together from them:

1. one pass counts the quotes of every range; a prefix scan of their parity over the ranges of a file (one row each) says
   which ranges begin inside a quoted field;
2. with that known, every task joins its lines into records by itself. What it cannot end, or did not begin, it
   hands on as a fragment: at most two a range, joined in a second, small step;
3. records are parsed by Spark's own CSV expression.

This holds for files in which a quote inside a field is doubled and all others open or close a field (RFC 4180).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paysight.runtime import scratch_root

QUOTE = '"'
WHOLE, BEGINS, GOES_ON, ENDS = 0, 3, 2, 1  # in the order in which fragments stand in a range
PIECES = "file string, block long, kind int, first boolean, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def open_ranges(lines: DataFrame) -> DataFrame:
    """(file, block) of the byte ranges that begin inside a quoted field."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    ranges = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    # one row per range
    before = F.sum("quotes").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    return ranges.withColumn("before", before).filter("before % 2 = 1").select("file", "block")


def _pieces(inside_at: np.ndarray):
    """A task's records and fragments; ``inside_at`` holds the sorted hashes of the ranges that begin inside a field."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: tuple[str, int] | None = None
        lines: list[str] = []
        inside = begun = False  # inside a quoted field; whether the record in hand began in this range
        fresh = True  # nothing of this range handed on yet
        out: list[tuple] = []

        def hand_on(kind: int) -> None:
            nonlocal fresh
            out.append((*here, kind, fresh and here[1] == 0, "\n".join(lines)))
            lines.clear()
            fresh = False

        for batch in batches:
            for value, file, block, key in zip(*(c.to_pylist() for c in batch.columns)):
                if here != (file, block):
                    if lines:
                        hand_on(BEGINS if begun else GOES_ON)
                    here, fresh = (file, block), True
                    at = np.searchsorted(inside_at, key)
                    inside = bool(at < len(inside_at) and inside_at[at] == key)
                    begun = not inside
                lines.append(value)
                inside ^= bool(value.count(QUOTE) & 1)
                if not inside:
                    hand_on(WHOLE if begun else ENDS)
                    begun = True
            yield pa.RecordBatch.from_pylist([dict(zip(("file", "block", "kind", "first", "text"), r)) for r in out], _KIND)
            out.clear()
        if lines:
            hand_on(BEGINS if begun else GOES_ON)
            yield pa.RecordBatch.from_pylist([dict(zip(("file", "block", "kind", "first", "text"), r)) for r in out], _KIND)

    return task


_KIND = pa.schema([("file", pa.string()), ("block", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("text", pa.string())])


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(text) of every record of the files at ``path`` but the first of each file, without its line end; empty lines are no records."""
    lines, key = _lines(spark, path), F.xxhash64("file", "block")
    # eight bytes per byte range that begins inside a field
    inside_at = np.sort(np.array([r[0] for r in open_ranges(lines).select(key).collect()], np.int64))
    pieces = lines.withColumn("key", key).mapInArrow(_pieces(inside_at), PIECES)
    spread = pieces.filter(F.col("kind") != WHOLE)
    record = F.sum(F.when(F.col("kind") == BEGINS, 1).otherwise(0)).over(Window.partitionBy("file").orderBy("block", "kind"))
    parts = F.array_sort(F.collect_list(F.struct("block", "kind", "text")))
    joined = spread.withColumn("record", record).groupBy("file", "record").agg(parts.alias("p"), F.bool_or("first").alias("first"))
    whole = pieces.filter(F.col("kind") == WHOLE).select("first", "text")
    every = whole.unionByName(joined.select("first", F.concat_ws("\n", "p.text").alias("text")))
    return every.filter(~F.col("first")).select(F.regexp_replace("text", "\r$", "").alias("text")).filter("text <> ''")


def read_csv_splits(spark: SparkSession, path: str, split_bytes: int | None = None, null_value: str | None = None) -> DataFrame:
    """All columns as text, the same rows as Spark's multi-line reader with a header gives.

    ``split_bytes`` sets the size of the byte ranges for this read alone; the parsed rows are then written to the shared
    checkpoint folder and read from there.
    """
    options = {"escape": QUOTE, "multiLine": "true"} | ({} if null_value is None else {"nullValue": null_value})
    columns = spark.read.options(header="true", inferSchema="false", **options).csv(path).columns
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    session = spark
    if split_bytes is not None:
        session = spark.newSession()
        session.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    rows = csv_records(session, path).select(F.from_csv("text", schema, options).alias("r")).select("r.*")
    if session is spark:
        return rows
    target = f"{scratch_root(spark).rstrip('/')}/paysight-stage/csv-{uuid.uuid4().hex}"
    rows.write.parquet(target)
    return spark.read.schema(rows.schema).parquet(target)
