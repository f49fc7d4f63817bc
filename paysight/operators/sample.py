"""Deterministic split and sample by key hash (T4, T5).

Both depend only on the row key, never on partitioning or task order, so
the same rows come out on any cluster layout and in any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysight.functions.buckets import Key, md5_bucket, md5_order_key


def with_split(df: DataFrame, key: Key, train_pct: int = 80, col: str = "split") -> DataFrame:
    """Add ``split`` = ``train`` when ``md5 bucket < train_pct`` else ``test``."""
    return df.withColumn(col, F.when(md5_bucket(key) < F.lit(train_pct), F.lit("train")).otherwise(F.lit("test")))


def hash_split(df: DataFrame, key: Key, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """Disjoint, complete train/test frames (narrow filters, no shuffle).

    A null key hashes like any other value, so every row falls on exactly one side."""
    b = md5_bucket(key)
    return df.where(b < F.lit(train_pct)), df.where(b >= F.lit(train_pct))


def _prefix(key: Key) -> Column:
    """First 32 bits of ``md5(key)`` as a number (same order as the hex text)."""
    return F.conv(F.substring(md5_order_key(key), 1, 8), 16, 10).cast("bigint")


def _row_order(df: DataFrame, key: Key) -> list:
    """Digest, key, then every other column that can be compared: rows that still tie are equal."""
    keys = [key] if isinstance(key, (str, Column)) else list(key)
    atoms = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType) and f.name not in keys]
    return [md5_order_key(key), *[F.col(k) if isinstance(k, str) else k for k in keys], *[F.col(f"`{c}`") for c in atoms]]


def hash_sample(df: DataFrame, key: Key, n: int = 50_000) -> DataFrame:
    """The first ``n`` rows in md5-of-key order: a reproducible fixed-size
    sample. Null keys hash like any value; rows with one key are taken in the
    order of the key and their other columns.

    A plain ``orderBy(...).limit(n)`` sends every task's local top ``n`` to
    one task, which does not scale with the number of partitions. md5 is
    uniform, and rows whose 32-bit digest prefix is below a threshold ``t``
    are exactly the first rows in md5 order. One aggregation counts the rows
    under a ladder of thresholds (halving each step); the smallest one that
    holds at least ``n`` rows (so about ``n`` to ``2n`` rows) filters the
    input before the ordered limit. The result equals the plain ordered
    limit, but the final sort sees only those rows.
    """
    full = 1 << 32
    ladder = [full >> j for j in range(40)]
    counts = (
        df.select(_prefix(key).alias("_p"))
        .agg(*[F.count_if(F.col("_p") < F.lit(t)).alias(f"c{j}") for j, t in enumerate(ladder)])
        .first()
    )
    threshold = full
    for j, t in enumerate(ladder):
        if counts[f"c{j}"] >= n:
            threshold = t
    kept = df if threshold >= full else df.where(_prefix(key) < F.lit(threshold))
    return kept.orderBy(*_row_order(df, key)).limit(n)
