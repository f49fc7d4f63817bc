"""Union by column name."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(frames: Iterable[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Stack frames by column name, keeping duplicates.

    With ``allow_missing`` a column absent from one side is filled with
    typed nulls; without it, differing column sets raise. Catalyst flattens
    the nested unions into one ``Union`` node, so the plan is a single
    narrow stage over all inputs.
    """
    frames = list(frames)
    if not frames:
        raise ValueError("union_by_name needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
