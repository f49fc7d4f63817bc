"""Linear models by slots: features, weights and optimality conditions as long tables.

A feature vector in long form has one row per non-zero slot. Scoring is then a join with a (slot, weight)
table and a sum, and the gradient of the fit one aggregation by slot; neither needs a vector or MLlib's
transformers, so both check them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, OneHotEncoderModel, RegexTokenizer, StandardScalerModel, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysight.operators.text import split_tokens
from paysight.runtime import maybe_broadcast

OTHER = "other"  # kind of the slot that null and unseen categories take
SLOTS = "column string, kind string, value string, slot int, scale double"
INTERCEPT = -1


def feature_slots(spark: SparkSession, pipeline: PipelineModel) -> DataFrame:
    """(column, kind, value, slot, scale) of a fitted feature pipeline: where every label, token and number goes,
    and what it is multiplied by. As many rows as the vector has slots."""
    rows: list[tuple] = []
    made: dict[str, list[tuple]] = {}  # output column -> its slots, in order
    indexed: dict[str, list[tuple]] = {}
    tokens: dict[str, str] = {}
    for stage in pipeline.stages:
        if isinstance(stage, StringIndexerModel):
            for source, out, labels in zip(stage.getInputCols(), stage.getOutputCols(), stage.labelsArray):
                indexed[out] = [*((source, "label", v) for v in labels), (source, OTHER, None)]
        elif isinstance(stage, OneHotEncoderModel):
            made |= {out: indexed[source] for source, out in zip(stage.getInputCols(), stage.getOutputCols())}
        elif isinstance(stage, RegexTokenizer):
            tokens[stage.getOutputCol()] = stage.getInputCol()
        elif isinstance(stage, CountVectorizerModel):
            made[stage.getOutputCol()] = [(tokens[stage.getInputCol()], "token", v) for v in stage.vocabulary]
        elif isinstance(stage, VectorAssembler):
            rows = [slot for c in stage.getInputCols() for slot in made.get(c, [(c, "number", None)])]
        elif isinstance(stage, StandardScalerModel):
            scale = [1.0 / s if s else 0.0 for s in stage.std]
    return spark.createDataFrame([(*row, k, float(scale[k])) for k, row in enumerate(rows)], SLOTS)


def long_features(df: DataFrame, slots: DataFrame, keys: Sequence[str], pattern: str = ";") -> DataFrame:
    """(keys, slot, value) of the non-zero scaled features of every row, from plain columns by joins.

    A null or unseen category goes to its column's "other" slot, an unseen token nowhere. Rows that share
    their keys are added up, so keys should be unique.
    """
    kinds = {r["column"]: r["kind"] for r in slots.filter(F.col("kind") != OTHER).select("column", "kind").distinct().collect()}
    entry = lambda c, kind, value, x: F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind"), value.alias("value"), x.alias("x"))
    tokens_of = lambda c: F.transform(split_tokens(c, pattern), lambda t: entry(c, "token", t, F.lit(1.0)))
    none = F.lit(None).cast("string")
    entries = []
    for c, kind in kinds.items():
        if kind == "token":
            entries.append(tokens_of(c))
        elif kind == "label":
            entries.append(F.array(entry(c, "label", F.col(c).cast("string"), F.lit(1.0))))
        else:
            entries.append(F.array(entry(c, "number", none, F.col(c).cast("double"))))
    rows = df.select(*keys, F.explode(F.concat(*[F.coalesce(e, F.array()) for e in entries])).alias("e")).select(*keys, "e.*")
    known, _ = maybe_broadcast(slots.filter(F.col("kind").isin("label", "token")).select("column", "value", F.col("slot").alias("own"), F.col("scale").alias("own_scale")))
    # one row per column
    rest, _ = maybe_broadcast(slots.filter(F.col("kind").isin(OTHER, "number")).select("column", F.col("slot").alias("rest"), F.col("scale").alias("rest_scale")))
    placed = rows.join(known, ["column", "value"], "left").join(rest, "column", "left")
    slot = F.when(F.col("kind") == "token", F.col("own")).otherwise(F.coalesce("own", "rest"))
    scale = F.when(F.col("kind") == "token", F.col("own_scale")).otherwise(F.coalesce("own_scale", "rest_scale"))
    placed = placed.select(*keys, slot.alias("slot"), (F.col("x") * scale).alias("x")).filter("slot IS NOT NULL AND x <> 0")
    return placed.groupBy(*keys, "slot").agg(F.sum("x").alias("value"))


def vector_slots(df: DataFrame, keys: Sequence[str], features: str = "features") -> DataFrame:
    """(keys, slot, value) of the non-zero slots of a vector column; a vector of zeros keeps its first slot, as 0."""
    slots = F.transform(vector_to_array(features), lambda x, i: F.struct(i.alias("slot"), x.alias("value")))
    return df.select(*keys, F.inline(F.filter(slots, lambda s: (s["value"] != 0) | (s["slot"] == 0))))


def saved_weights(spark: SparkSession, path: str) -> DataFrame:
    """(slot, weight) of a saved linear model; its intercept has slot -1."""
    data = spark.read.parquet(f"{path.rstrip('/')}/data")
    weights = data.select(F.posexplode(vector_to_array("coefficients")).alias("slot", "weight"))
    return weights.unionByName(data.select(F.lit(INTERCEPT).alias("slot"), F.col("intercept").alias("weight")))


def linear_scores(features: DataFrame, weights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, pred_log, salary_pred) of rows in long form, from a (slot, weight) table."""
    table, _ = maybe_broadcast(weights.filter(F.col("slot") != INTERCEPT))
    intercept = weights.filter(F.col("slot") == INTERCEPT).agg(F.coalesce(F.sum("weight"), F.lit(0.0)).alias("_intercept"))
    summed = features.join(table, "slot", "left").groupBy(*keys).agg(F.coalesce(F.sum(F.col("value") * F.col("weight")), F.lit(0.0)).alias("pred_log"))
    # the intercept is one row
    summed = summed.crossJoin(F.broadcast(intercept)).withColumn("pred_log", F.col("pred_log") + F.col("_intercept")).drop("_intercept")
    return summed.withColumn("salary_pred", F.expm1("pred_log"))


def slot_sums(pred: DataFrame, features: str = "features", label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(slot, n, x, xx, xe, y, yy) in one aggregation: for every slot the sums of x, x² and x times the residual; slot -1 has x = 1
    (so n, and the sum of residuals) and the sums of the label and its square."""
    entry = lambda slot, x: F.struct(slot.cast("int").alias("slot"), x.alias("x"))
    slots = F.transform(vector_to_array(features), lambda x, i: entry(i, x))
    entries = F.concat(F.array(entry(F.lit(INTERCEPT), F.lit(1.0))), F.filter(slots, lambda s: s["x"] != 0))
    rows = pred.select(F.col(label).alias("y"), (F.col(label) - F.col(prediction)).alias("e"), F.inline(entries))
    x, y = F.col("x"), F.when(F.col("slot") == INTERCEPT, F.col("y"))
    return rows.groupBy("slot").agg(
        F.sum(x).alias("x"), F.sum(x * x).alias("xx"), F.sum(x * F.col("e")).alias("xe"), F.sum(y).alias("y"), F.sum(y * y).alias("yy")
    )


def linear_conditions(pred: DataFrame, weights: DataFrame, params: Mapping, features: str = "features", label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(slot, weight, gradient, excess): how far every weight is from the elastic net's optimum on the training rows.

    In standard units (slots and label divided by their deviations) with q = regParam / sd(label) and
    a = elasticNetParam, the optimum has, for the correlation g of a slot with the residual:
    g = q (a sign(w) + (1 - a) w) where w is not zero, |g| <= q a where it is, and residuals that sum to zero (slot -1).
    ``excess`` is the distance from that. A slot that never varies has weight zero.
    """
    sums = slot_sums(pred, features, label, prediction)
    total = sums.filter(F.col("slot") == INTERCEPT).select(
        F.col("x").alias("n"), F.col("xe").alias("e"), F.sqrt(F.col("yy") / F.col("x") - F.pow(F.col("y") / F.col("x"), 2)).alias("sd_y")
    )
    q, a = F.lit(float(params["regParam"])) / F.col("sd_y"), float(params["elasticNetParam"])
    n, sd = F.col("n"), F.sqrt(F.greatest(F.col("xx") / F.col("n") - F.pow(F.col("x") / F.col("n"), 2), F.lit(0.0)))
    # the total is one row
    joined = weights.join(sums, "slot", "left").fillna(0.0, ["x", "xx", "xe"]).join(F.broadcast(total))
    joined = joined.withColumn("sd", sd).withColumn("w", F.col("weight") * F.col("sd") / F.col("sd_y"))
    g = (F.col("xe") - F.col("x") * F.col("e") / n) / n / (F.col("sd") * F.col("sd_y"))
    joined = joined.withColumn("gradient", F.when(F.col("slot") == INTERCEPT, F.col("e") / n / F.col("sd_y")).when(F.col("sd") > 1e-9, g))
    w, g = F.col("w"), F.col("gradient")
    excess = (
        F.when(F.col("slot") == INTERCEPT, F.abs(g))
        .when(g.isNull(), F.abs("weight"))
        .when(w == 0, F.greatest(F.abs(g) - q * a, F.lit(0.0)))
        .otherwise(F.abs(g - q * (a * F.signum(w) + (1 - a) * w)))
    )
    return joined.select("slot", "weight", "gradient", excess.alias("excess"))
