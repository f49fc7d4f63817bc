"""Free-text answers to numbers, as native Column expressions.

Both stay inside whole-stage codegen: no Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _first_integer(text: Column) -> Column:
    """First run of ASCII digits as a double, or null when there is none."""
    digits = F.regexp_extract(text, r"(\d+)", 1)
    return F.when(digits != "", digits.try_cast("double"))


def years_to_double(c: str | Column) -> Column:
    """Years of experience as a double.

    Rules, first match wins: null stays null; surrounding white space is
    stripped; empty or ``na`` (any case) is null; ``less than 1 year`` is
    0.5; ``more than ...`` is its first integer (or null); a number parses
    as itself; anything else is its first integer (or null).
    """
    raw = _col(c)
    text = F.regexp_replace(raw.cast("string"), r"^\s+|\s+$", "")
    low = F.lower(text)
    return (
        F.when(raw.isNull(), F.lit(None).cast("double"))
        .when((text == "") | (low == "na"), F.lit(None).cast("double"))
        .when(low.contains("less than 1 year"), F.lit(0.5))
        .when(low.contains("more than"), _first_integer(text))
        .otherwise(F.coalesce(text.try_cast("double"), _first_integer(text)))
    )


def age_to_double(c: str | Column) -> Column:
    """Age band as a double.

    ``Under 18`` is 17, ``65 years or older`` is 65, no digits is null, one
    number is that number, otherwise the mean of the first two numbers.
    Matching is case-sensitive and the text is not stripped.
    """
    raw = _col(c).cast("string")
    nums = F.regexp_extract_all(raw, F.lit(r"(\d+)"), 1)
    first = nums.getItem(0).try_cast("double")
    second = nums.getItem(1).try_cast("double")
    return (
        F.when(raw.isNull(), F.lit(None).cast("double"))
        .when(raw.contains("Under 18"), F.lit(17.0))
        .when(raw.contains("65 years or older"), F.lit(65.0))
        .when(F.size(nums) == 0, F.lit(None).cast("double"))
        .when(F.size(nums) == 1, first)
        .otherwise((first + second) / 2.0)
    )
