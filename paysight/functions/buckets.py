"""Deterministic hash buckets and equal-width bins as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


Key = str | Column | Sequence[str | Column]

# What a null key hashes as: a value like any other.
NULL_KEY = "\\N"


def key_digest(key: Key) -> Column:
    """md5 of the key's text; of several columns, of their texts joined by ``|``. Never null."""
    parts = [key] if isinstance(key, (str, Column)) else list(key)
    texts = [F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit(NULL_KEY)) for k in parts]
    return F.md5(texts[0] if len(texts) == 1 else F.concat_ws("|", *texts))


def md5_bucket(key: Key, buckets: int = 100) -> Column:
    """``pmod(first 32 bits of md5(key as text), buckets)``.

    Independent of partitioning and of the engine: the same number comes
    out of any SQL engine with ``md5``.
    """
    head = F.substring(key_digest(key), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(buckets))


def md5_order_key(key: Key) -> Column:
    """Sort key for a deterministic pseudo-random order of rows."""
    return key_digest(key)


def equal_width_bin(x: str | Column, lo: float, hi: float, bins: int) -> Column:
    """Bin index in ``[0, bins)`` over ``[lo, hi]``; the last bin is closed.

    ``bin = least(floor((x - lo) * bins / (hi - lo)), bins - 1)``. With
    ``hi == lo`` every value lands in bin 0.
    """
    c = F.col(x) if isinstance(x, str) else x
    if hi <= lo:
        return F.when(c.isNotNull(), F.lit(0))
    raw = F.floor((c - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo)).cast("int")
    return F.least(raw, F.lit(bins - 1))
