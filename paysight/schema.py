"""Declared survey schema and schema-tolerant projections."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TARGET = "ConvertedCompYearly"
YEAR = "SurveyYear"

# The survey column names the pipeline knows about.
TEXT_SOURCE_COLUMNS = [
    "ResponseId",
    "Country",
    "Age",
    "Employment",
    "EdLevel",
    "YearsCode",
    "YearsCodePro",
    "DevType",
    "OrgSize",
    "Currency",
    "LanguageHaveWorkedWith",
    "DatabaseHaveWorkedWith",
    "PlatformHaveWorkedWith",
    "WebframeHaveWorkedWith",
    "MiscTechHaveWorkedWith",
    "ToolsTechHaveWorkedWith",
    "NEWCollabToolsHaveWorkedWith",
    "SurveyLength",
    "SurveyEase",
    "MainBranch",
    "RemoteWork",
]
NUMERIC_SOURCE_COLUMNS = ["ConvertedCompYearly", "CompTotal"]

# Columns kept for the silver stage.
CORE_COLUMNS = [
    "SurveyYear",
    "ConvertedCompYearly",
    "CompTotal",
    "Country",
    "MainBranch",
    "DevType",
    "Employment",
    "YearsCodePro",
    "YearsCode",
    "Age",
    "EdLevel",
    "OrgSize",
    "RemoteWork",
    "LanguageHaveWorkedWith",
    "DatabaseHaveWorkedWith",
]

SKILL_COLUMNS = ["LanguageHaveWorkedWith", "DatabaseHaveWorkedWith"]

SURVEY_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in TEXT_SOURCE_COLUMNS]
    + [T.StructField(c, T.DoubleType(), True) for c in NUMERIC_SOURCE_COLUMNS]
    + [T.StructField(YEAR, T.IntegerType(), True)]
)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Raise ``ValueError`` naming every required column that is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns {missing}; have {df.columns}")
    return df


def available(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The subset of ``columns`` present in ``df``, in the order asked."""
    have = set(df.columns)
    return [c for c in columns if c in have]


def select_strict(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Projection that fails on an absent column."""
    columns = list(columns)
    require_columns(df, columns)
    return df.select(*columns)


def select_available(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Projection of whichever requested columns exist."""
    return df.select(*available(df, columns))


def safe_double(col: str | Column) -> Column:
    """Cast to double, null when the text is not a number.

    ``cast`` raises under ANSI mode; ``try_cast`` does not.
    """
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(T.DoubleType())


def align_to_schema(
    df: DataFrame, schema: T.StructType = SURVEY_SCHEMA, keep_extra: bool = True
) -> DataFrame:
    """Bind columns by name to ``schema``.

    Declared columns that are absent become typed nulls; present ones are
    converted with ``try_cast``. Extra source columns are kept as they are
    unless ``keep_extra`` is false.
    """
    have = set(df.columns)
    declared = []
    for field in schema.fields:
        if field.name in have:
            declared.append(F.col(field.name).try_cast(field.dataType).alias(field.name))
        else:
            declared.append(F.lit(None).cast(field.dataType).alias(field.name))
    names = {f.name for f in schema.fields}
    extra = [F.col(c) for c in df.columns if c not in names] if keep_extra else []
    return df.select(*declared, *extra)
