"""Silver -> gold feature vectors, and gold -> trained models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysight.operators.features import FeatureSpec, fit_features
from paysight.operators.filters import positive
from paysight.operators.models import GBT_V1, GBT_V2, LR_V1, LR_V2, evaluate, train_gbt, train_lr, with_label
from paysight.operators.quantiles import DEFAULT_REL_ERROR
from paysight.functions.buckets import md5_order_key
from paysight.operators.sample import hash_split
from paysight.operators.text import fill_text
from paysight.operators.trim import trim_quantiles
from paysight.runtime import stage_table
from paysight.schema import TARGET, YEAR, available, require_columns

# A response number is unique within one survey year only.
KEYS = [YEAR, "ResponseId"]

# The layout of training rows (and so the fitted trees) follows from the rows alone, not from the cluster's cores, and no
# partition grows with the table. A small table spreads early. Later partitions are large: every one hands on the sums
# of all tree nodes, level by level, so their number rather than the rows would decide what a fit shuffles.
ROWS_PER_PARTITION = 500_000
FEW_ROWS, FEW_PARTITIONS = 20_000, 24


def partitions_for(n: int) -> int:
    return max(n // ROWS_PER_PARTITION + 1, min(n // FEW_ROWS + 1, FEW_PARTITIONS))


def row_keys(df: DataFrame) -> list[str]:
    return available(df, KEYS)


def gold(
    silver_df: DataFrame,
    spec: FeatureSpec | None = None,
    fit_on: str = "all",
    train_pct: int = 80,
) -> tuple[DataFrame, PipelineModel]:
    """Positive-salary rows -> ``(SurveyYear, ResponseId, features, target)`` plus the
    fitted pipeline (M7, M8, S13). Missing and empty answers get the same fill as in :func:`score`.

    ``fit_on="all"`` fits vocabularies, labels and scales on every row (the
    original behaviour); ``"train"`` fits them only on the rows the hash
    split puts in training, so test rows never shape the features.
    """
    require_columns(silver_df, [TARGET])
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on must be 'all' or 'train'")
    df = positive(silver_df, TARGET)
    spec = spec or FeatureSpec.resolve(df)
    keys = row_keys(df)
    df = fill_text(df, spec.text, empty_too=True)
    keep = available(df, dict.fromkeys([*keys, TARGET, *spec.numeric, *spec.categorical, *spec.text]))
    # read by every fitting pass and the final transform: stage it once
    df = stage_table(df.select(*keep), "gold-input")
    fit_rows = df
    if fit_on == "train":
        require_columns(df, KEYS[-1:])
        fit_rows, _ = hash_split(df, keys, train_pct)
    model = fit_features(fit_rows, spec)
    out_cols = [*keys, "features", TARGET]
    return model.transform(df).select(*out_cols), model


def training_rows(gold_df: DataFrame, trim: bool, rel_error: float, train_pct: int, fixed_layout: bool):
    df = gold_df
    if trim:
        df = trim_quantiles(positive(df, TARGET), TARGET, 0.01, 0.99, rel_error)
    keys = row_keys(df)
    labelled = with_label(df).select(*keys, "features", "label")
    train_df, test_df = hash_split(labelled, keys, train_pct)
    return (laid_out(train_df) if fixed_layout else train_df), test_df


def laid_out(train_df: DataFrame) -> DataFrame:
    """Training rows dealt by key into a number of partitions that follows from their count, and sorted there."""
    keys = row_keys(train_df)
    return train_df.repartition(partitions_for(train_df.count()), *keys).sortWithinPartitions(md5_order_key(keys), *keys, "label")


def train_gbt_only(
    gold_df: DataFrame,
    version: str = "v1",
    train_pct: int = 80,
    rel_error: float = DEFAULT_REL_ERROR,
):
    """The boosted-trees model of ``version`` alone, on the same training
    rows :func:`train` uses (for scoring jobs that need only it)."""
    require_columns(gold_df, ["features", TARGET, KEYS[-1]])
    _, gbt_params, trim = SETTINGS[version]
    train_df, _ = training_rows(gold_df, trim, rel_error, train_pct, True)
    train_df = train_df.persist()
    try:
        return train_gbt(train_df, gbt_params)
    finally:
        train_df.unpersist()


@dataclass
class TrainResult:
    metrics: DataFrame
    models: dict
    train_rows: DataFrame
    test_rows: DataFrame


SETTINGS = {"v1": (LR_V1, GBT_V1, False), "v2": (LR_V2, GBT_V2, True)}


def train(
    gold_df: DataFrame,
    version: str = "v1",
    train_pct: int = 80,
    rel_error: float = DEFAULT_REL_ERROR,
    gbt_overrides: dict | None = None,
) -> TrainResult:
    """Label, optional 1-99 % trim (v2), hash split on the row key, fit LR
    and GBT, evaluate both on the held-out rows (L1-L4, L6, L7, T5).

    The training rows are dealt by key into partitions of a bounded size, so
    GBT sees the same layout on every run and any cluster.
    """
    require_columns(gold_df, ["features", TARGET, KEYS[-1]])
    lr_params, gbt_params, trim = SETTINGS[version]
    gbt_params = {**gbt_params, **(gbt_overrides or {})}
    train_df, test_df = training_rows(gold_df, trim, rel_error, train_pct, False)
    fit_rows = laid_out(train_df).persist()
    try:
        lr = train_lr(fit_rows, lr_params)
        gbt = train_gbt(fit_rows, gbt_params)
    finally:
        fit_rows.unpersist()
    rows = []
    for name, model in ((f"lr_{version}", lr), (f"gbt_{version}", gbt)):
        rows.append(evaluate(model.transform(test_df)).withColumn("model", F.lit(name)))
    metrics = rows[0].unionByName(rows[1])
    return TrainResult(metrics, {f"lr_{version}": lr, f"gbt_{version}": gbt}, train_df, test_df)
