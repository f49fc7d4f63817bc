"""Incremental landing of survey files with Structured Streaming.

The batch bronze job lands a fixed set of yearly files. When new yearly
files keep arriving in a folder, the same landing runs as a stream: a file
source tracks which files are new (exactly once, in the checkpoint), and
each micro-batch reads those files with the batch CSV reader, so columns
bind by header name even when files of different years have different
columns. ``availableNow`` processes everything present and stops, so the
job can be scheduled like a batch.

Only file *names* reach the driver, at most ``MAX_FILES`` per batch unless the
caller names another bound, and the batch's plan has one scan for each of them; the
rows are read, dealt out by year and written by the executors. Each batch writes
its own ``landing_batch`` partition with dynamic overwrite, so a batch that
is retried after a failure replaces its earlier output instead of adding
to it.

The year comes from the file name (``..._<year>.csv`` by default).
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysight.runtime import checkpoint_dir
from paysight.schema import SURVEY_SCHEMA, YEAR, align_to_schema
from paysight.sources.files import BATCH_COL, dealt_by_year, read_survey_csv, refuse_layout
from paysight.operators.union import union_by_name

YEAR_PATTERN = r"(\d{4})\D*\.csv$"
MAX_FILES = 100  # of one micro-batch


def new_files(spark: SparkSession, folder: str, max_files_per_trigger: int = MAX_FILES) -> DataFrame:
    """Stream of paths of CSV files appearing in ``folder`` (content not read)."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.csv")
    )
    return reader.option("maxFilesPerTrigger", max_files_per_trigger).load(folder).select("path")


def _year_of(path: str, pattern: str) -> int | None:
    m = re.search(pattern, path)
    return int(m.group(1)) if m else None


def land_files(spark: SparkSession, paths: list[str], bronze_path: str, batch_id: int, pattern: str = YEAR_PATTERN, null_value: str | None = None) -> None:
    """Read ``paths`` by header name, align to the declared schema and write
    them as partition ``landing_batch=batch_id`` of the bronze table. A path that the batch job
    writes (by year alone) is refused."""
    refuse_layout(spark, bronze_path, f"{YEAR}=*/*.parquet")
    frames = [read_survey_csv(spark, p, year=_year_of(p, pattern), null_value=null_value) for p in sorted(paths)]
    df = align_to_schema(union_by_name(frames), SURVEY_SCHEMA)
    (
        dealt_by_year(df)
        .withColumn(BATCH_COL, F.lit(int(batch_id)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(YEAR, BATCH_COL)
        .parquet(bronze_path)
    )


def land_stream(
    spark: SparkSession,
    folder: str,
    bronze_path: str,
    checkpoint: str | None = None,
    year_pattern: str = YEAR_PATTERN,
    max_files_per_trigger: int = MAX_FILES,
    null_value: str | None = None,
) -> None:
    """Land every not-yet-landed file of ``folder`` into bronze and stop.

    Progress lives in ``checkpoint`` (default: a sub-folder of the shared
    ``spark.checkpoint.dir``); a rerun resumes after the last committed
    batch.
    """
    if checkpoint is None:
        root = checkpoint_dir(spark)
        if root is None:
            raise ValueError("pass checkpoint= or set spark.checkpoint.dir")
        digest = hashlib.md5(f"{folder}|{bronze_path}".encode()).hexdigest()[:16]
        checkpoint = f"{root.rstrip('/')}/paysight-landing/{digest}"

    def land_batch(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.collect()]  # file names only
        if paths:
            land_files(batch.sparkSession, paths, bronze_path, batch_id, year_pattern, null_value)

    query = (
        new_files(spark, folder, max_files_per_trigger)
        .writeStream.foreachBatch(land_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
