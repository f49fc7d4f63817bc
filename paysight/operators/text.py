"""Multi-select answers: fill, tokenise, join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysight.schema import SKILL_COLUMNS

# Fixed value: the text a missing skills answer is replaced with.
MISSING_SKILLS = "None"


def fill_text(
    df: DataFrame,
    cols: Sequence[str] = SKILL_COLUMNS,
    value: str = MISSING_SKILLS,
    empty_too: bool = False,
) -> DataFrame:
    """Replace null (and, with ``empty_too``, empty) answers with ``value``.

    The silver table fills only nulls. Requests also arrive as ``''`` when
    nothing was picked, so ``gold`` and ``score`` both pass ``empty_too=True``:
    the features are the same on both sides.
    """
    out = df
    for c in cols:
        if c not in df.columns:
            continue
        x = F.col(c)
        missing = x.isNull() | (x == "") if empty_too else x.isNull()
        out = out.withColumn(c, F.when(missing, F.lit(value)).otherwise(x))
    return out


def split_tokens(c: str | Column, pattern: str = ";", lower: bool = True, min_length: int = 1) -> Column:
    """Tokens the way ``RegexTokenizer(pattern=..., gaps=True)`` makes them:
    lower-cased, split on the pattern, tokens shorter than ``min_length``
    dropped. A null answer gives null (the ML stage would raise)."""
    x = F.col(c) if isinstance(c, str) else c
    if lower:
        x = F.lower(x)
    return F.filter(F.split(x, pattern), lambda t: F.length(t) >= min_length)


def join_choices(choices: Column, sep: str = ";") -> Column:
    """Selected options back to one answer string."""
    return F.concat_ws(sep, choices)
