"""Row filters (F1-F11). All are plain predicates Catalyst can push down."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysight.schema import TARGET

# Words that mark a software role in the job-type answer.
ROLE_WORDS = ["developer", "engineer", "devops", "sre", "data scientist", "machine learning"]


def role_pattern(words: Sequence[str] = ROLE_WORDS, word_boundary: bool = False) -> str:
    """Case-insensitive alternation of ``words`` (optionally whole words)."""
    body = "|".join(words)
    return f"(?i)\\b({body})\\b" if word_boundary else f"(?i)({body})"


def population_clauses(
    df: DataFrame,
    branch_word: str = "developer",
    employment_word: str = "employed",
    role_words: Sequence[str] = ROLE_WORDS,
    target: str = TARGET,
    word_boundary: bool = False,
    exclude_employment: str | None = None,
) -> list[Column]:
    """One clause per column that exists; absent columns add no clause."""
    clauses: list[Column] = []
    if "MainBranch" in df.columns:
        clauses.append(F.lower(F.col("MainBranch")).contains(branch_word))
    if "Employment" in df.columns:
        emp = F.lower(F.col("Employment"))
        clause = emp.contains(employment_word)
        if exclude_employment:
            clause = clause & ~emp.contains(exclude_employment)
        clauses.append(clause)
    if "DevType" in df.columns:
        clauses.append(F.col("DevType").rlike(role_pattern(role_words, word_boundary)))
    if target in df.columns:
        clauses.append(F.col(target).isNotNull())
    return clauses


def population_filter(df: DataFrame, **kwargs) -> DataFrame:
    """Working-developer population.

    The conjunction starts from ``lit(True)``; SQL three-valued logic drops
    rows whose tested text is null. ``contains("employed")`` also keeps
    "Not employed..." answers unless ``exclude_employment`` is given.
    """
    cond = reduce(lambda a, b: a & b, population_clauses(df, **kwargs), F.lit(True))
    return df.where(cond)


def positive(df: DataFrame, col: str = TARGET) -> DataFrame:
    """Not null and strictly positive (F2)."""
    return df.where(F.col(col).isNotNull() & (F.col(col) > 0))


def within(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Closed range ``lo <= x <= hi``."""
    return df.where(F.col(col).between(F.lit(lo), F.lit(hi)))


def at_most(df: DataFrame, col: str, hi: float) -> DataFrame:
    """Upper cut ``x <= hi``."""
    return df.where(F.col(col) <= F.lit(hi))


def drop_any_null(df: DataFrame, subset: Iterable[str]) -> DataFrame:
    """Drop rows with a null in any of ``subset``."""
    return df.dropna(how="any", subset=list(subset))
