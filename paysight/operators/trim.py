"""Quantile trims (A6 + F6, L6) and median imputation (M0)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysight.operators.filters import within
from paysight.operators.quantiles import DEFAULT_REL_ERROR, exact_quantiles, quantile_values
from paysight.schema import TARGET


@dataclass(frozen=True)
class Bounds:
    lo: float
    hi: float


def fit_bounds(
    df: DataFrame,
    col: str = TARGET,
    lower: float = 0.01,
    upper: float = 0.99,
    rel_error: float = DEFAULT_REL_ERROR,
) -> Bounds | None:
    """Quantile bounds; ``None`` for a frame with no value (Q16)."""
    vals = quantile_values(df, col, [lower, upper], rel_error)
    if not vals or vals[0] is None:
        return None
    return Bounds(float(vals[0]), float(vals[1]))


def apply_bounds(df: DataFrame, bounds: Bounds | None, col: str = TARGET) -> DataFrame:
    if bounds is None:
        return df
    return within(df, col, bounds.lo, bounds.hi)


def trim_quantiles(
    df: DataFrame,
    col: str = TARGET,
    lower: float = 0.01,
    upper: float = 0.99,
    rel_error: float = DEFAULT_REL_ERROR,
) -> DataFrame:
    """Keep rows with ``q_lower <= x <= q_upper``; empty input is unchanged.

    ``rel_error=0.01`` reproduces the original setting, which on typical
    data returns the minimum and maximum and so removes nothing.
    """
    if col not in df.columns:
        return df
    return apply_bounds(df, fit_bounds(df, col, lower, upper, rel_error), col)


def fit_medians(
    df: DataFrame, cols: Sequence[str], rel_error: float = DEFAULT_REL_ERROR
) -> dict[str, float]:
    """Median per column, ignoring null and NaN; all-null columns are left out.

    Sketch mode is one ``approxQuantile`` pass over all columns. Exact mode
    unpivots the columns to ``(name, value)`` and runs one grouped exact
    selection, so the number of passes does not grow with the columns.
    """
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return {}
    if rel_error > 0:
        vals = df.approxQuantile(cols, [0.5], rel_error)
        return {c: v[0] for c, v in zip(cols, vals) if v}
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("_m_col"), F.col(c).cast("double").alias("_m_x")) for c in cols])
        ).alias("_m")
    ).select("_m._m_col", "_m._m_x")
    rows = exact_quantiles(long, "_m_x", [0.5], by=["_m_col"], names=["median"]).collect()
    return {r["_m_col"]: r["median"] for r in rows if r["median"] is not None}


def apply_medians(df: DataFrame, medians: dict[str, float], suffix: str = "_imp") -> DataFrame:
    """``c_imp = c`` unless null or NaN, then the fitted median."""
    out = df
    for c, m in medians.items():
        x = F.col(c).cast("double")
        out = out.withColumn(c + suffix, F.when(x.isNull() | F.isnan(x), F.lit(float(m))).otherwise(x))
    return out


def impute_median(
    df: DataFrame, cols: Sequence[str], rel_error: float = DEFAULT_REL_ERROR, suffix: str = "_imp"
) -> DataFrame:
    """Median imputation (M0). A column with no value at all is copied
    unchanged into its ``_imp`` column (the ML ``Imputer`` would raise)."""
    present = [c for c in cols if c in df.columns]
    medians = fit_medians(df, present, rel_error)
    out = apply_medians(df, medians, suffix)
    for c in present:
        if c not in medians:
            out = out.withColumn(c + suffix, F.col(c).cast("double"))
    return out
