"""Profiles and the tables behind every chart.

Every function returns a DataFrame computed on the whole input; nothing is
sampled or collected except scalar bounds.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysight.functions.buckets import equal_width_bin
from paysight.operators.quantiles import DEFAULT_REL_ERROR, quantile_values, quantiles_by
from paysight.runtime import SmallTable
from paysight.schema import TARGET, YEAR


def _q(c: str):
    return F.col(f"`{c}`")


def _not_nan(x):
    """NaN takes no part in a quantile, in any mode."""
    return F.when(~F.isnan(x), x)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    r = right
    for k in keys:
        r = r.withColumnRenamed(k, f"_j_{k}")
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"_j_{k}"]) for k in keys])
    return left.join(r, cond, how).drop(*[f"_j_{k}" for k in keys])


def profile(
    df: DataFrame,
    target: str = TARGET,
    by: Sequence[str] = (),
    rel_error: float = DEFAULT_REL_ERROR,
    method: str = "histogram",
) -> DataFrame:
    """Rows, non-null and null target counts, mean and median.

    Sketch mode is one aggregation. Exact mode adds the exact median,
    joined on the (few) group keys.
    """
    by = list(by)
    x = F.col(target)
    stats = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count(x).alias("n_salary_not_null"),
        F.count_if(x.isNull()).alias("n_salary_null"),
        F.avg(x).alias("mean_salary"),
    ]
    if rel_error > 0 and method == "sketch":
        accuracy = int(round(1.0 / rel_error))
        stats.append(F.percentile_approx(_not_nan(x), 0.5, accuracy).alias("median_salary"))
        out = df.groupBy(*by).agg(*stats)
    else:
        counts = df.groupBy(*by).agg(*stats)
        if by:
            med = quantiles_by(df, target, [0.5], by=by, names=["median_salary"], rel_error=rel_error, method=method)
            out = _null_safe_join(counts, med, by)
        else:
            vals = quantile_values(df, target, [0.5], rel_error=rel_error)
            median = vals[0] if vals else None
            out = counts.withColumn("median_salary", F.lit(median).cast("double"))
    return out.orderBy(*by) if by else out


def missingness(df: DataFrame, top_n: int | None = 20, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing count and rate per column, largest first.

    One pass: a single aggregation with one ``count_if`` per column, then a
    local unpivot of that one row.
    """
    columns = list(columns) if columns else list(df.columns)
    one = df.agg(
        F.count(F.lit(1)).alias("_m_total"),
        *[F.count_if(_q(c).isNull()).alias(f"_m_{i}") for i, c in enumerate(columns)],
    )
    long = one.select(
        F.col("_m_total"),
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("col"), F.col(f"_m_{i}").alias("missing")) for i, c in enumerate(columns)])
        ).alias("_m"),
    ).select(
        F.col("_m.col").alias("col"),
        F.col("_m.missing").alias("missing"),
        (F.col("_m.missing") / F.greatest(F.col("_m_total"), F.lit(1)) * 100.0).alias("missing_pct"),
    )
    long = long.orderBy(F.desc("missing_pct"), F.asc("col"))
    return long.limit(top_n) if top_n else long


def top_k(df: DataFrame, col: str, k: int = 15) -> DataFrame:
    """Most frequent values, ties by value (A7, T2, C4): partial counts then
    ``TakeOrderedAndProject`` (per-task top-k, merged)."""
    return (
        df.groupBy(col)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc_nulls_first(col))
        .limit(k)
    )


def _quartile_columns(out: DataFrame, keys: Sequence[str]) -> DataFrame:
    return out.select(
        *keys,
        "n",
        "p25",
        "median_salary",
        "p75",
        (F.col("median_salary") - F.col("p25")).alias("err_low"),
        (F.col("p75") - F.col("median_salary")).alias("err_high"),
    )


def quartiles_by_dimension(
    df: DataFrame,
    dims: Sequence[tuple[str, int, int]],
    target: str = TARGET,
    rel_error: float = DEFAULT_REL_ERROR,
    method: str = "histogram",
) -> DataFrame:
    """Group quartiles for several dimensions at once.

    ``dims`` holds ``(column, top_n, min_count)``. Rows are stacked to
    ``(dimension, value, target)`` so one grouped pass serves every
    dimension. Per dimension, groups with at least ``min_count`` rows are
    kept, the ``top_n`` largest (ties by value, nulls first). Output is long:
    ``dimension, value, n, p25, median_salary, p75, err_low, err_high``.
    """
    stacked = df.select(
        F.col(target).alias("_t"),
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c, _, _ in dims])
        ),
    )
    keys = ["dimension", "value"]
    if rel_error > 0 and method == "sketch":
        accuracy = int(round(1.0 / rel_error))
        stats = stacked.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.percentile_approx(_not_nan(F.col("_t")), [0.25, 0.5, 0.75], accuracy).alias("_gq")
        )
        stats = stats.select(
            *keys, "n", F.col("_gq")[0].alias("p25"), F.col("_gq")[1].alias("median_salary"), F.col("_gq")[2].alias("p75")
        )
        tops = [
            stats.where((F.col("dimension") == c) & (F.col("n") >= min_n))
            .orderBy(F.desc("n"), F.asc_nulls_first("value"))
            .limit(top_n)
            for c, top_n, min_n in dims
        ]
        return _quartile_columns(reduce(lambda a, b: a.unionByName(b), tops), keys)
    counts = stacked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    tops = [
        counts.where((F.col("dimension") == c) & (F.col("n") >= min_n))
        .orderBy(F.desc("n"), F.asc_nulls_first("value"))
        .limit(top_n)
        for c, top_n, min_n in dims
    ]
    # at most sum(top_n) rows: a parameter-bounded table
    sizes = SmallTable(reduce(lambda a, b: a.unionByName(b), tops))
    kept = _null_safe_join(stacked, sizes.for_join().select(*keys), keys, how="left_semi")
    q = quantiles_by(
        kept, "_t", [0.25, 0.5, 0.75], by=keys, names=["p25", "median_salary", "p75"], rel_error=rel_error, method=method
    )
    # q has one row per kept group: at most sum(top_n) rows, a proven bound
    return _quartile_columns(_null_safe_join(sizes.df, F.broadcast(q), keys), keys)


def group_quartiles(
    df: DataFrame,
    group_col: str,
    target: str = TARGET,
    top_n: int = 15,
    min_count: int = 300,
    rel_error: float = DEFAULT_REL_ERROR,
    method: str = "histogram",
) -> DataFrame:
    """Quartiles for one dimension, keyed by the column itself; quantiles
    are computed only for the kept groups."""
    long = quartiles_by_dimension(df, [(group_col, top_n, min_count)], target, rel_error, method)
    typed = long.select(F.col("value").cast(df.schema[group_col].dataType).alias(group_col), *long.columns[2:])
    return typed.orderBy(F.desc("n"), F.asc_nulls_first(group_col))


def trend(
    df: DataFrame,
    target: str = TARGET,
    year: str = YEAR,
    rel_error: float = DEFAULT_REL_ERROR,
    method: str = "histogram",
) -> DataFrame:
    """Rows and median target per year."""
    if rel_error > 0 and method == "sketch":
        accuracy = int(round(1.0 / rel_error))
        out = df.groupBy(year).agg(
            F.count(F.lit(1)).alias("n"), F.percentile_approx(_not_nan(F.col(target)), 0.5, accuracy).alias("median_salary")
        )
    else:
        n = df.groupBy(year).agg(F.count(F.lit(1)).alias("n"))
        med = quantiles_by(df, target, [0.5], by=[year], names=["median_salary"], rel_error=rel_error, method=method)
        out = _null_safe_join(n, med, [year])
    return out.orderBy(year)


def value_range(df: DataFrame, col: str) -> tuple[float, float] | None:
    row = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    if row is None or row["lo"] is None:
        return None
    return float(row["lo"]), float(row["hi"])


def histogram(
    df: DataFrame,
    col: str,
    bins: int = 60,
    bounds: tuple[float, float] | None = None,
) -> DataFrame:
    """Equal-width histogram over the whole column.

    Bounds default to the column's min and max (one small aggregation);
    the counting is a partial aggregation on the bin index. Empty bins are
    not emitted.
    """
    x = F.col(col)
    data = df.where(x.isNotNull() & ~F.isnan(x))
    if bounds is None:
        bounds = value_range(data, col)
    if bounds is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint")
    lo, hi = bounds
    width = (hi - lo) / bins
    b = equal_width_bin(x, lo, hi, bins)
    return (
        data.where((x >= F.lit(lo)) & (x <= F.lit(hi)))
        .groupBy(b.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "bin",
            (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
            (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
            "n",
        )
        .orderBy("bin")
    )


def scatter_bins(df: DataFrame, x: str, y: str, bins: int = 60) -> DataFrame:
    """Rows per cell of an equal-width grid over two columns (C7, C9): ``x_bin, y_bin, x_lo, y_lo, n``.

    All rows with two finite values are counted; empty cells are not emitted. At most ``bins``
    squared rows come out, whatever the input.
    """
    fine = lambda c: F.coalesce(F.abs(F.col(c)) < F.lit(float("inf")), F.lit(False))
    data = df.where(fine(x) & fine(y))
    row = data.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    if row[0] is None:
        return df.sparkSession.createDataFrame([], "x_bin int, y_bin int, x_lo double, y_lo double, n bigint")
    x0, x1, y0, y1 = (float(v) for v in row)
    cells = data.groupBy(equal_width_bin(x, x0, x1, bins).alias("x_bin"), equal_width_bin(y, y0, y1, bins).alias("y_bin"))
    low = lambda lo, hi, b: F.lit(lo) + F.col(b) * F.lit((hi - lo) / bins)
    counted = cells.agg(F.count(F.lit(1)).alias("n"))
    return counted.select("x_bin", "y_bin", low(x0, x1, "x_bin").alias("x_lo"), low(y0, y1, "y_bin").alias("y_lo"), "n")


def corr_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation matrix in long form ``(a, b, corr)`` over rows
    complete in ``cols`` (A15, C6): one aggregation for all pairs."""
    cols = [c for c in cols if c in df.columns]
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], "a string, b string, corr double")
    pairs = list(itertools.combinations_with_replacement(range(len(cols)), 2))
    data = df.dropna(subset=cols)
    one = data.agg(*[F.corr(_q(cols[i]), _q(cols[j])).alias(f"_c{i}_{j}") for i, j in pairs])
    entries = []
    for i, j in pairs:
        entries.append(F.struct(F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b"), F.col(f"_c{i}_{j}").alias("corr")))
        if i != j:
            entries.append(F.struct(F.lit(cols[j]).alias("a"), F.lit(cols[i]).alias("b"), F.col(f"_c{i}_{j}").alias("corr")))
    return one.select(F.inline(F.array(*entries)))
