"""Regressors on log pay, metrics, diagnostics and batch scoring (L1-L10,
A17-A20)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysight.operators.profile import histogram, scatter_bins
from paysight.operators.quantiles import DEFAULT_REL_ERROR, quantile_values
from paysight.operators.sample import hash_sample
from paysight.operators.text import fill_text
from paysight.schema import SKILL_COLUMNS, TARGET

# The two training settings for each model family.
LR_V1 = {"maxIter": 50, "regParam": 0.05, "elasticNetParam": 0.0}
LR_V2 = {"maxIter": 100, "regParam": 0.01, "elasticNetParam": 0.5}
GBT_V1 = {"maxIter": 60, "maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.8, "seed": 42}
GBT_V2 = {"maxIter": 80, "maxDepth": 8, "stepSize": 0.1, "subsamplingRate": 0.8, "seed": 42}


def with_label(df: DataFrame, target: str = TARGET, label: str = "label") -> DataFrame:
    """Positive targets only, ``label = log1p(target)``."""
    return df.where(F.col(target).isNotNull() & (F.col(target) > 0)).withColumn(label, F.log1p(F.col(target)))


def train_lr(train: DataFrame, params: Mapping = LR_V1, features: str = "features", label: str = "label"):
    """MLlib linear regression (L1, L2). With few features the solver is the
    normal equation: one distributed pass to build ``X'X``."""
    return LinearRegression(featuresCol=features, labelCol=label, **dict(params)).fit(train)


def train_gbt(train: DataFrame, params: Mapping = GBT_V1, features: str = "features", label: str = "label"):
    """MLlib gradient-boosted trees (L3, L4), always seeded.

    Tree construction depends on the input layout, so callers that need
    run-to-run equality should pass a frame with a fixed partitioning.
    """
    return GBTRegressor(featuresCol=features, labelCol=label, **dict(params)).fit(train)


def _metrics(label: str, prediction: str) -> list:
    y, p = F.col(label), F.col(prediction)
    err = y - p
    t, s = F.expm1(y), F.expm1(p)
    has = p.isNotNull()
    return [
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(err * err)).alias("rmse_log"),
        # null for a constant label, where it is not defined
        (F.lit(1.0) - F.try_divide(F.sum(err * err), F.var_pop(y) * F.count(y))).alias("r2_log"),
        F.avg(F.when(has, F.abs(t - s))).alias("mae"),
        F.sqrt(F.avg(F.when(has, (t - s) * (t - s)))).alias("rmse"),
        F.count_if(s == F.lit(float("inf"))).alias("n_infinite"),
    ]


def evaluate(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """All metrics in one aggregation.

    Log scale: ``rmse_log``, ``r2_log`` (as ``RegressionEvaluator``). Real
    scale after ``expm1``: ``mae``, ``rmse`` over rows with a prediction;
    ``n_infinite`` counts predictions whose ``expm1`` overflows.
    """
    return pred.agg(*_metrics(label, prediction))


def evaluate_clipped(
    pred: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    lower: float = 0.01,
    upper: float = 0.99,
    rel_error: float = DEFAULT_REL_ERROR,
) -> DataFrame:
    """:func:`evaluate` plus the real-scale errors of predictions clamped to
    the label's quantile range (``mae_clipped``, ``rmse_clipped``), so an
    overflowing ``expm1`` cannot dominate them. One aggregation after the
    clip bounds are fitted."""
    clipped = clip_predictions(pred, label, prediction, lower, upper, rel_error)
    t, s = F.expm1(F.col(label)), F.expm1(F.col("prediction_clip"))
    return clipped.agg(
        *_metrics(label, prediction),
        F.avg(F.abs(t - s)).alias("mae_clipped"),
        F.sqrt(F.avg((t - s) * (t - s))).alias("rmse_clipped"),
    )


def best_model(metrics: DataFrame, name: str = "model", metric: str = "rmse_log") -> DataFrame:
    """Lowest ``metric``; on a tie the linear model wins."""
    tie = F.when(F.col(name).startswith("lr"), F.lit(0)).otherwise(F.lit(1))
    return metrics.orderBy(F.asc(metric), tie, F.asc(name)).limit(1)


def clip_predictions(
    pred: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    lower: float = 0.01,
    upper: float = 0.99,
    rel_error: float = DEFAULT_REL_ERROR,
) -> DataFrame:
    """``prediction_clip`` = prediction clamped to the label's quantile
    range (X11)."""
    vals = quantile_values(pred, label, [lower, upper], rel_error)
    if not vals:
        return pred.withColumn("prediction_clip", F.col(prediction))
    lo, hi = vals
    return pred.withColumn("prediction_clip", F.greatest(F.lit(lo), F.least(F.col(prediction), F.lit(hi))))


def diagnostics(
    pred: DataFrame,
    key,
    label: str = "label",
    prediction: str = "prediction",
    bins: int = 60,
    sample_size: int | None = None,
    rel_error: float = DEFAULT_REL_ERROR,
) -> dict[str, DataFrame]:
    """The three diagnostic tables per model (L10, C9, X14), over all rows:

    * ``scatter_log`` — counts per (label bin, prediction bin);
    * ``scatter_real`` — the same on the money scale with clipped predictions;
    * ``residual_hist`` — histogram of ``label - prediction``.

    With ``sample_size`` the scatter tables are single points instead, an
    md5-ordered sample of that many rows.
    """
    clipped = clip_predictions(pred, label, prediction, rel_error=rel_error)
    resid = clipped.withColumn("residual", F.col(label) - F.col(prediction))
    real = {"actual": F.expm1(F.col(label)), "pred_clipped": F.expm1(F.col("prediction_clip"))}
    out = {"residual_hist": histogram(resid, "residual", bins)}
    if sample_size is None:
        out["scatter_log"] = scatter_bins(resid, label, prediction, bins)
        out["scatter_real"] = scatter_bins(resid.withColumns(real), "actual", "pred_clipped", bins)
        return out
    keys = [key] if isinstance(key, str) else list(key)
    sample = hash_sample(resid.select(*keys, label, prediction, "prediction_clip"), key, sample_size)
    out["scatter_log"] = sample.select(*keys, F.col(label).alias("actual_log"), F.col(prediction).alias("pred_log"))
    out["scatter_real"] = sample.select(*keys, *[c.alias(n) for n, c in real.items()])
    return out


def score(
    requests: DataFrame,
    pipeline: PipelineModel,
    regressor,
    text_cols=SKILL_COLUMNS,
) -> DataFrame:
    """Batch scoring (L9): any number of request rows through the fitted
    feature pipeline and regressor. Missing and empty skill answers get the
    same fill as training. Adds ``pred_log`` and ``salary_pred``. With a mapping
    of names to regressors the features are made once for all of them, and the
    added columns begin with the name and an underscore."""
    filled = fill_text(requests, text_cols, empty_too=True)
    out = pipeline.transform(filled)
    named = {f"{k}_": m for k, m in regressor.items()} if isinstance(regressor, Mapping) else {"": regressor}
    for name, model in named.items():
        out = model.transform(out).withColumnRenamed("prediction", f"{name}pred_log")
        out = out.withColumn(f"{name}salary_pred", F.expm1(F.col(f"{name}pred_log")))
    return out
