"""File sources and sinks: survey CSV, bronze/silver/gold Parquet, reports
(S1-S5, S8, S9, S12)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysight.operators.union import union_by_name
from paysight.sources.csv_splits import read_csv_splits
from paysight.schema import (
    NUMERIC_SOURCE_COLUMNS,
    SURVEY_SCHEMA,
    YEAR,
    align_to_schema,
    available,
    safe_double,
    select_strict,
)


BATCH_COL = "landing_batch"  # second partition column of a table written by the landing stream
YEAR_SALTS = 64  # parts that one year's rows are dealt into before they are written


def read_survey_csv(
    spark: SparkSession,
    path: str,
    year: int | None = None,
    columns: Sequence[str] | None = None,
    null_tokens: Sequence[str] = (),
    null_value: str | None = None,
    split_bytes: int | None = None,
) -> DataFrame:
    """One survey file, every field read as text.

    Header names bind columns (a schema handed to the CSV reader would bind
    by position). Quoted fields may span lines and ``""`` escapes a quote.
    ``columns`` makes a strict projection; the money columns are converted
    with ``try_cast``; ``null_tokens`` (e.g. ``NA``) become null. By default an
    empty field is null; with ``null_value`` only that marker (and an unquoted
    empty field) is, and a quoted empty text stays one.

    Spark gives each multi-line CSV file to one task (the sinks deal its rows out
    before they write). With ``split_bytes`` files are read in byte ranges of that size
    instead, by :mod:`paysight.sources.csv_splits`.
    """
    if split_bytes is not None:
        df = read_csv_splits(spark, path, split_bytes, null_value)
    else:
        reader = (
            spark.read.option("header", True)
            .option("multiLine", True)
            .option("escape", '"')
            .option("inferSchema", False)
        )
        df = (reader if null_value is None else reader.option("nullValue", null_value)).csv(path)
    if columns is not None:
        df = select_strict(df, columns)
    if null_tokens:
        tokens = list(null_tokens)
        df = df.select(*[F.when(F.col(f"`{c}`").isin(tokens), None).otherwise(F.col(f"`{c}`")).alias(c) for c in df.columns])
    for c in NUMERIC_SOURCE_COLUMNS:
        if c in df.columns:
            df = df.withColumn(c, safe_double(c))
    if year is not None:
        df = df.withColumn(YEAR, F.lit(int(year)))
    return df


def read_survey_years(
    spark: SparkSession,
    paths: Mapping[int, str],
    columns: Sequence[str] | None = None,
    align: bool = True,
    allow_missing: bool = True,
    null_value: str | None = None,
    split_bytes: int | None = None,
) -> DataFrame:
    """All yearly files as one frame (S3, U1, U2): each tagged with its year,
    stacked by column name, optionally bound to the declared schema.
    ``null_value`` and ``split_bytes`` are those of :func:`read_survey_csv`."""
    frames = [read_survey_csv(spark, p, y, columns, null_value=null_value, split_bytes=split_bytes) for y, p in sorted(paths.items())]
    df = union_by_name(frames, allow_missing=allow_missing)
    return align_to_schema(df, SURVEY_SCHEMA) if align else df


def dealt_by_year(df: DataFrame) -> DataFrame:
    """Rows dealt by year and a salt."""
    salt = F.pmod(F.xxhash64(*available(df, ["ResponseId"]) or [F.lit(0)]), F.lit(YEAR_SALTS))
    return df.repartition(F.col(YEAR), salt)


def refuse_layout(spark: SparkSession, path: str, pattern: str) -> None:
    """Raise if ``path`` holds anything like ``pattern``: a table whose files lie at two depths cannot be read as one."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{pattern}")
    if glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob):
        raise ValueError(f"{path} is a bronze table of another layout ({pattern}); the batch job and the landing stream need a path each")


def write_bronze(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Land survey rows as Parquet partitioned by year (S8), so a reader
    asking for some years prunes the rest. Only the years in ``df`` are
    replaced. Rows are dealt by year and a salt first: a multi-line CSV file is
    one task however large, and a year is more than one file. A path that the landing stream
    writes (by year and batch) is refused."""
    refuse_layout(df.sparkSession, path, f"{YEAR}=*/{BATCH_COL}=*")
    dealt_by_year(df).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(YEAR).parquet(path)


def read_bronze(spark: SparkSession, path: str, years: Sequence[int] | None = None) -> DataFrame:
    """Bronze rows (S4); ``years`` becomes a partition filter."""
    df = spark.read.parquet(path)
    if years is not None:
        df = df.where(F.col(YEAR).isin([int(y) for y in years]))
    return df


def read_year_dir(spark: SparkSession, path: str, year: int) -> DataFrame:
    """A per-year Parquet directory; adds the year when the files lack it."""
    df = spark.read.parquet(path)
    if YEAR not in df.columns:
        df = df.withColumn(YEAR, F.lit(int(year)))
    return df


def write_table(df: DataFrame, path: str, partitions: int | None = None, mode: str = "overwrite") -> None:
    """Parquet sink (S5, S9). ``partitions`` forces a file count; left
    unset, AQE sizes the output."""
    out = df.repartition(partitions) if partitions else df
    out.write.mode(mode).parquet(path)


def write_report(report: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """Report table ``(metric, value)`` as JSON lines or Parquet."""
    report.coalesce(1).write.mode(mode).format(fmt).save(path)
