"""EDA: every chart's table and the summary report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysight.operators.filters import at_most, positive
from paysight.operators.profile import corr_long, histogram, missingness, quartiles_by_dimension, scatter_bins, top_k, trend
from paysight.operators.quantiles import DEFAULT_REL_ERROR, quantile_values
from paysight.operators.sample import hash_sample
from paysight.operators.union import union_by_name
from paysight.schema import TARGET, YEAR, available

# Chart settings (column, top n, minimum group size).
QUARTILE_GROUPS = [("RemoteWork", 10, 300), ("EdLevel", 12, 300), ("OrgSize", 12, 300)]
CORR_COLUMNS = ["AgeNum_imp", "YearsCodeNum_imp", "YearsCodeProNum_imp", "CompTotal", "ConvertedCompYearly"]

# The key columns of each chart's table; its other columns are measures.
CHART_KEYS = {
    "missing_top20": ["col"],
    "salary_hist_raw": ["bin"],
    "salary_hist_log": ["bin"],
    "top_countries": ["CountryGrouped"],
    "corr": ["a", "b"],
    "trend": [YEAR],
    "report": ["metric"],
    "quartiles": ["dimension", "value"],
    "scatter_years_pro": ["x_bin", "y_bin"],
}


def salary_hist_frame(df: DataFrame, q99: float | None) -> DataFrame:
    """Rows kept for the salary histograms: positive and ``<= q99``, with
    ``log_salary`` for the log chart."""
    base = positive(df, TARGET)
    if q99 is not None:
        base = at_most(base, TARGET, q99)
    return base.withColumn("log_salary", F.log1p(F.col(TARGET)))


def report(df: DataFrame, rel_error: float = DEFAULT_REL_ERROR) -> DataFrame:
    """Summary ``(metric, value)``: usable rows and salary q01/median/q99
    (S12). One count plus one quantile job."""
    usable = positive(df, TARGET)
    n = usable.count()
    qs = quantile_values(usable, TARGET, [0.01, 0.5, 0.99], rel_error) or [None, None, None]
    rows = [("usable_rows", float(n)), ("salary_q01", qs[0]), ("salary_median", qs[1]), ("salary_q99", qs[2])]
    return df.sparkSession.createDataFrame(rows, "metric string, value double")


def eda(
    silver_df: DataFrame, rel_error: float = DEFAULT_REL_ERROR, method: str = "histogram", sample_points: int | None = None
) -> dict[str, DataFrame]:
    """All chart tables on the positive-salary rows of ``silver_df``.

    ``method`` picks how grouped approximate quantiles are computed
    (``"sketch"`` or the fan-in-free ``"histogram"``). The scatter table counts
    all rows by cell; ``sample_points`` adds a table of that many single points."""
    df = positive(silver_df, TARGET)
    qs = quantile_values(df, TARGET, [0.99], rel_error)
    hist_rows = salary_hist_frame(df, qs[0] if qs else None)
    out = {
        "missing_top20": missingness(df, 20),
        "salary_hist_raw": histogram(hist_rows, TARGET, 60),
        "salary_hist_log": histogram(hist_rows, "log_salary", 60),
        "top_countries": top_k(df, "CountryGrouped", 15) if "CountryGrouped" in df.columns else None,
        "corr": corr_long(df, CORR_COLUMNS),
        "trend": trend(df, rel_error=rel_error, method=method),
        "report": report(silver_df, rel_error),
    }
    dims = [d for d in QUARTILE_GROUPS if d[0] in df.columns]
    if dims:
        out["quartiles"] = quartiles_by_dimension(df, dims, TARGET, rel_error, method)
    if "YearsCodeProNum_imp" in df.columns:
        keys = available(df, [YEAR, "ResponseId"])
        pts = df.select(*keys, F.col("YearsCodeProNum_imp").alias("x"), F.log1p(F.col(TARGET)).alias("y")).dropna(subset=["x", "y"])
        out["scatter_years_pro"] = scatter_bins(pts, "x", "y")
        if sample_points:
            out["scatter_years_pro_points"] = hash_sample(pts, keys, sample_points)
    return {k: v for k, v in out.items() if v is not None}


def long_charts(tables: dict[str, DataFrame]) -> DataFrame:
    """All chart tables as one of (chart, a, b, measure, value): ``a`` and ``b`` are the keys as text."""
    parts = []
    for name, df in tables.items():
        keys = CHART_KEYS[name]
        a, b = [*(F.col(c).cast("string") for c in keys), F.lit(None).cast("string")][:2]
        measures = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in df.columns if c not in keys])
        parts.append(df.select(F.lit(name).alias("chart"), a.alias("a"), b.alias("b"), F.inline(measures)))
    return union_by_name(parts, allow_missing=False)
