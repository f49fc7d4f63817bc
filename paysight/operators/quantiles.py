"""Quantiles: one-pass sketches, or exact values by distributed selection.

Semantics follow Spark's ``percentile_disc`` and ``percentile_approx``: the
p-quantile of n values is the value at 1-based rank ``max(1, ceil(p * n))``
in ascending order (a real value, never an interpolation). Nulls and NaN are
ignored.

``rel_error > 0`` uses Spark's Greenwald-Khanna sketch (``percentile_approx``
per group, ``approxQuantile`` globally): one pass, memory bounded by the
accuracy, rank error at most ``rel_error * n``. ``method="histogram"`` gives
the same guarantee through the mergeable selection below, stopping once a
bracket holds at most ``rel_error * n`` values.

``rel_error == 0`` is exact and every step is a mergeable aggregation or a
bounded window:

1. one aggregation counts values per (group, bin) over 65,536 fixed bins of
   ``sign(x) * log1p(|x|)`` (log-spaced, so any range and any skew is
   covered without a prior min/max pass). Partial counts combine map-side
   and the shuffle is keyed by bin, so a group holding a third of all rows
   still spreads over many reducers;
2. a window over each group's bins (at most 65,536 rows) finds the bin that
   holds each target rank: that bin's ``[min, max]`` is the bracket and the
   rank inside it is known. Bins are checked to be contiguous in value; if
   they ever were not, one counting pass re-bases the rank exactly;
3. while a bracket still holds more than ``max_candidates`` values, an
   equal-width histogram of the bracket narrows it further;
4. a window over the remaining candidates per (group, p) picks the row.

No per-group value map or sketch buffer is merged in one task, and nothing
goes through the driver except the largest bracket size (a scalar) per
round.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paysight.runtime import SmallTable

DEFAULT_REL_ERROR = 1e-4
MAX_CANDIDATES = 2_000_000
LOG_BINS = 1 << 16
# |sign(x) * log1p(|x|)| < 710 for every finite double
_T_SPAN = 710.0
REFINE_BINS = 4096
MAX_ROUNDS = 64

_X = "_q_x"
_P = "_q_p"


def _valid(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x)


class _State(SmallTable):
    """A per (group, p) bracket table."""


def _key_join(left: DataFrame, right: "_State", keys: list[str]) -> DataFrame:
    """Null-safe equi-join of ``left`` with a small per-key table.

    The table is broadcast only when its (already counted) size is within
    the bound; otherwise it is a shuffle join that AQE can de-skew.
    """
    renamed = right.for_join()
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    out = left.join(renamed, cond, "inner")
    return out.drop(*[f"_r_{k}" for k in keys])


def _rank(p: float, n: Column) -> Column:
    return F.greatest(F.lit(1).cast("bigint"), F.ceil(F.lit(float(p)) * n).cast("bigint"))


def _prepare(df: DataFrame, col: str | Column, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    x = (F.col(col) if isinstance(col, str) else col).cast("double")
    keys = list(by) if by else ["_q_g"]
    cols = [F.col(k) for k in by] if by else [F.lit(0).alias("_q_g")]
    base = df.select(*cols, x.alias(_X)).where(_valid(F.col(_X)))
    return base, keys


def _log_bin(x: Column) -> Column:
    """Fixed log-spaced bin of ``x``: monotone in ``x`` (checked per group)."""
    t = F.signum(x) * F.log1p(F.abs(x))
    width = 2 * _T_SPAN / LOG_BINS
    raw = F.floor((t + F.lit(_T_SPAN)) / F.lit(width))
    return (
        F.when(t >= F.lit(_T_SPAN), F.lit(LOG_BINS - 1))
        .when(t <= F.lit(-_T_SPAN), F.lit(0))
        .otherwise(F.least(F.greatest(raw, F.lit(0)), F.lit(LOG_BINS - 1)))
        .cast("int")
    )


BIN_COLUMNS = ["_q_b", "_q_c", "_q_min", "_q_max"]  # bin, values, least and largest of them


def value_bin(x: Column) -> Column:
    """The fixed bin of a double in which the selection counts it; null for null. Counts by it may be kept and added up."""
    return F.when(x.isNotNull(), _log_bin(x))


def _histogram_state(
    base: DataFrame, keys: list[str], probs: Sequence[float], tolerance: float = 0.0, counts: DataFrame | None = None
) -> tuple[DataFrame, bool, "_State"]:
    """Per (group, p): the log bin holding rank ``k``, as a bracket with the
    rank re-based to it. Returns the state and whether every group's bins
    were contiguous in value (then the re-based rank is exact). ``counts`` are the bins of all
    rows where they are known already."""
    hist = counts
    if hist is None:
        hist = base.groupBy(*keys, _log_bin(F.col(_X)).alias("_q_b")).agg(
            F.count(F.lit(1)).alias("_q_c"), F.min(_X).alias("_q_min"), F.max(_X).alias("_q_max")
        )
    # at most LOG_BINS rows per group reach these windows
    by_bin = Window.partitionBy(*keys).orderBy("_q_b")
    running = by_bin.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    h = (
        hist.withColumn("_q_cum", F.sum("_q_c").over(running))
        .withColumn("_q_total", F.sum("_q_c").over(whole))
        .withColumn("_q_prev_max", F.lag("_q_max").over(by_bin))
        .withColumn("_q_breaks", F.sum(F.when(F.col("_q_prev_max") >= F.col("_q_min"), 1).otherwise(0)).over(whole))
    )
    per_p = F.array(*[F.struct(F.lit(i).alias(_P), _rank(p, F.col("_q_total")).alias("_q_k")) for i, p in enumerate(probs)])
    h = h.select("*", F.inline(per_p))
    hit = h.where((F.col("_q_cum") >= F.col("_q_k")) & (F.col("_q_cum") - F.col("_q_c") < F.col("_q_k")))
    state = hit.select(
        *keys,
        _P,
        (F.col("_q_k") - (F.col("_q_cum") - F.col("_q_c"))).alias("_q_k"),
        F.col("_q_k").alias("_q_k_abs"),
        F.col("_q_min").alias("_q_lo"),
        F.col("_q_max").alias("_q_hi"),
        F.col("_q_c").alias("_q_n"),
        F.col("_q_breaks"),
        # brackets this small may answer with their lower end (approximate mode)
        F.floor(F.lit(float(tolerance)) * F.col("_q_total")).cast("bigint").alias("_q_tol"),
    )
    held = _State(state)
    contiguous = held.df.agg(F.max("_q_breaks")).first()[0] in (None, 0)
    return held.df, contiguous, held


def _count_state(base: DataFrame, state: _State, keys: list[str]) -> DataFrame:
    """Values below the bracket and inside it; rank re-based to the bracket.

    A bracket that misses its rank (it cannot under the sketch guarantee,
    but this keeps results exact regardless) is widened to all values of
    the group, with the rank unchanged.
    """
    j = _key_join(base, state, keys)
    x, lo, hi = F.col(_X), F.col("_q_lo"), F.col("_q_hi")
    counts = j.groupBy(*keys, _P).agg(
        F.count_if(x < lo).alias("_q_below"),
        F.count_if((x >= lo) & (x <= hi)).alias("_q_in"),
        F.count(F.lit(1)).alias("_q_all"),
        F.min(x).alias("_q_min"),
        F.max(x).alias("_q_max"),
    )
    s = state.df.alias("s")
    c = counts.alias("c")
    cond = reduce(
        lambda a, b: a & b,
        [F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys] + [F.col(f"s.{_P}") == F.col(f"c.{_P}")],
    )
    joined = s.join(c, cond, "left")
    below = F.coalesce(F.col("c._q_below"), F.lit(0))
    inside = F.coalesce(F.col("c._q_in"), F.lit(0))
    k_rel = F.col("s._q_k") - below
    ok = (k_rel >= 1) & (k_rel <= inside)
    return joined.select(
        *[F.col(f"s.{k}").alias(k) for k in keys],
        F.col(f"s.{_P}").alias(_P),
        F.col("s._q_tol").alias("_q_tol"),
        F.when(ok, k_rel).otherwise(F.col("s._q_k")).alias("_q_k"),
        F.when(ok, F.col("s._q_lo")).otherwise(F.col("c._q_min")).alias("_q_lo"),
        F.when(ok, F.col("s._q_hi")).otherwise(F.col("c._q_max")).alias("_q_hi"),
        F.when(ok, inside).otherwise(F.col("c._q_all")).alias("_q_n"),
    )


def _candidates(base: DataFrame, state: _State, keys: list[str]) -> DataFrame:
    j = _key_join(base, state, keys)
    x = F.col(_X)
    return j.where((x >= F.col("_q_lo")) & (x <= F.col("_q_hi")))


def _refine(base: DataFrame, state: _State, keys: list[str], bins: int) -> DataFrame:
    """Shrink every bracket to the equal-width bin that holds its rank."""
    cand = _candidates(base, state, keys)
    lo, hi, x = F.col("_q_lo"), F.col("_q_hi"), F.col(_X)
    width = hi - lo
    inf = F.lit(float("inf"))
    # monotone in x; infinite bracket ends park finite values in the middle bin
    b = (
        F.when(x <= lo, F.lit(0))
        .when(x >= hi, F.lit(bins - 1))
        .when(width == inf, F.lit(bins // 2))
        .otherwise(F.least(F.floor((x - lo) * F.lit(float(bins)) / width), F.lit(bins - 1)))
    )
    hist = (
        cand.withColumn("_q_b", b.cast("int"))
        .groupBy(*keys, _P, "_q_k", "_q_tol", "_q_b")
        .agg(F.count(F.lit(1)).alias("_q_c"), F.min(_X).alias("_q_min"), F.max(_X).alias("_q_max"))
    )
    w = Window.partitionBy(*keys, _P).orderBy("_q_b").rowsBetween(Window.unboundedPreceding, 0)
    cum = hist.withColumn("_q_cum", F.sum("_q_c").over(w))
    hit = cum.where((F.col("_q_cum") >= F.col("_q_k")) & (F.col("_q_cum") - F.col("_q_c") < F.col("_q_k")))
    return hit.select(
        *keys,
        _P,
        (F.col("_q_k") - (F.col("_q_cum") - F.col("_q_c"))).alias("_q_k"),
        F.col("_q_min").alias("_q_lo"),
        F.col("_q_max").alias("_q_hi"),
        F.col("_q_c").alias("_q_n"),
        "_q_tol",
    )


def _open() -> Column:
    """Brackets that still need ranking: more than one value and more values
    than the rank tolerance allows."""
    return (F.col("_q_lo") < F.col("_q_hi")) & (F.col("_q_n") > F.col("_q_tol"))


def _select(base: DataFrame, state: _State, keys: list[str]) -> DataFrame:
    """Pick the ranked value. A closed bracket (``L == U``, or within the
    rank tolerance) answers with its lower end; only open brackets (each at
    most ``max_candidates`` rows) go through the window, and when none is
    open the data is not read again."""
    open_ = _open()
    resolved = state.df.where(~open_).select(*keys, _P, F.col("_q_lo").alias("_q_v"))
    if state.df.where(open_).count() == 0:
        return resolved
    cand = _candidates(base, state, keys).where(open_)
    w = Window.partitionBy(*keys, _P).orderBy(_X)
    picked = (
        cand.withColumn("_q_rn", F.row_number().over(w))
        .where(F.col("_q_rn") == F.col("_q_k"))
        .select(*keys, _P, F.col(_X).alias("_q_v"))
    )
    return picked.unionByName(resolved)


def exact_quantiles(
    df: DataFrame,
    col: str | Column,
    probs: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    max_candidates: int = MAX_CANDIDATES,
    rank_tolerance: float = 0.0,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Lower quantiles per group: one row per group, one column per p.

    ``counts`` (``by`` and BIN_COLUMNS) are the values by :func:`value_bin`, if a caller keeps them; the
    first pass is left out then, and ``df`` need only hold the values of the bins in which a rank falls (all
    values if bins overlap, which the counts show).

    Exact by default. With ``rank_tolerance = e`` a bracket holding at most
    ``e * n`` values answers with its smallest value, so the result is a real
    value whose rank is off by less than ``e * n`` (the sketch guarantee),
    computed with the same mergeable passes.
    """
    probs = [float(p) for p in probs]
    names = list(names) if names else [f"q{i}" for i in range(len(probs))]
    base, keys = _prepare(df, col, by)
    state_df, contiguous, held = _histogram_state(base, keys, probs, rank_tolerance, counts)
    if contiguous:
        state = held  # extra columns are ignored downstream
    else:
        # a bin straddled its neighbour: re-base the rank by counting
        absolute = _State(
            state_df.select(*keys, _P, F.col("_q_k_abs").alias("_q_k"), "_q_lo", "_q_hi", "_q_n", "_q_tol")
        )
        state = _State(_count_state(base, absolute, keys))
        absolute.release()
        held.release()
    for _ in range(MAX_ROUNDS):
        biggest = state.df.where(_open()).agg(F.max("_q_n")).first()[0]
        if biggest is None or biggest <= max_candidates:
            break
        narrower = _State(_refine(base, state, keys, REFINE_BINS))
        state.release()
        state = narrower
    else:  # a round narrows a bracket by REFINE_BINS, so doubles run out of bits long before
        raise RuntimeError(f"a quantile bracket still holds {biggest} values after {MAX_ROUNDS} rounds")
    picked = _select(base, state, keys)
    wide = picked.groupBy(*keys).agg(
        *[F.max(F.when(F.col(_P) == i, F.col("_q_v"))).alias(n) for i, n in enumerate(names)]
    )
    if not by:
        wide = wide.drop("_q_g")
    return wide


def approx_quantiles(
    df: DataFrame,
    col: str | Column,
    probs: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    rel_error: float = DEFAULT_REL_ERROR,
    method: str = "sketch",
) -> DataFrame:
    """Approximate quantiles per group, rank error at most ``rel_error * n``.

    ``method="sketch"`` is Spark's ``percentile_approx`` (one pass; the
    partial sketches of one group merge in one reducer). ``"histogram"``
    uses the mergeable histogram selection of :func:`exact_quantiles` with
    a rank tolerance: no single-reducer merge for a hot group, at the cost of
    a second pass when a bracket is still too wide.
    """
    if method == "histogram":
        return exact_quantiles(df, col, probs, by=by, names=names, rank_tolerance=rel_error)
    if method != "sketch":
        raise ValueError("method must be 'sketch' or 'histogram'")
    probs = [float(p) for p in probs]
    names = list(names) if names else [f"q{i}" for i in range(len(probs))]
    accuracy = max(1, int(math.ceil(1.0 / rel_error)))
    base, keys = _prepare(df, col, by)
    agg = base.groupBy(*keys).agg(F.percentile_approx(_X, probs, accuracy).alias("_q_arr"))
    out = agg.select(*keys, *[F.col("_q_arr").getItem(i).alias(n) for i, n in enumerate(names)])
    if not by:
        out = out.drop("_q_g")
    return out


def quantiles_by(
    df: DataFrame,
    col: str | Column,
    probs: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    rel_error: float = DEFAULT_REL_ERROR,
    method: str = "sketch",
) -> DataFrame:
    """Quantiles per group; exact when ``rel_error == 0``."""
    if rel_error <= 0:
        return exact_quantiles(df, col, probs, by=by, names=names)
    return approx_quantiles(df, col, probs, by=by, names=names, rel_error=rel_error, method=method)


def quantile_values(
    df: DataFrame, col: str, probs: Sequence[float], rel_error: float = DEFAULT_REL_ERROR
) -> list[float] | None:
    """Global quantiles as driver scalars; ``None`` when no value exists.

    The sketch path is ``DataFrame.approxQuantile`` (tree-aggregated GK
    summaries); the exact path is :func:`exact_quantiles`.
    """
    probs = [float(p) for p in probs]
    if rel_error > 0:
        vals = df.approxQuantile(col, probs, rel_error)
        return vals if vals else None
    row = exact_quantiles(df, col, probs).first()
    if row is None or row[0] is None:
        return None
    return [float(v) for v in row]
