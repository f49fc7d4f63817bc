"""Model sinks and sources (S10, S11) and the request table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("YearsCodeProNum_imp", T.DoubleType(), True),
        T.StructField("CountryGrouped", T.StringType(), True),
        T.StructField("EdLevel", T.StringType(), True),
        T.StructField("RemoteWork", T.StringType(), True),
        T.StructField("OrgSize", T.StringType(), True),
        T.StructField("LanguageHaveWorkedWith", T.StringType(), True),
        T.StructField("DatabaseHaveWorkedWith", T.StringType(), True),
    ]
)


def save_model(model, path: str) -> None:
    """Any ``MLWritable``, overwriting."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_regressor(path: str, kind: str):
    """``kind`` is ``lr`` or ``gbt``."""
    if kind == "gbt":
        return GBTRegressionModel.load(path)
    if kind == "lr":
        return LinearRegressionModel.load(path)
    raise ValueError(f"unknown model kind {kind!r}")


def requests_frame(spark: SparkSession, rows: Iterable[Mapping]) -> DataFrame:
    """Request rows from Python mappings with the declared schema.

    Meant for a handful of interactive requests; batch scoring reads a
    table instead.
    """
    names = REQUEST_SCHEMA.fieldNames()
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, REQUEST_SCHEMA)
