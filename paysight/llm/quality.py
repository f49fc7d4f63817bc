"""Quality classifier: ridge regression on random Fourier features, then isotonic calibration.

Each text becomes a few document statistics. Random cosine features of the standardised statistics
approximate a Gaussian kernel. Every task sums the products of its rows' features (as whole numbers
of a fixed unit, so the sums do not depend on how rows are dealt), Spark adds the tasks' sums, and
the driver solves one small linear system. A second part of the labelled rows, binned by the raw
score, gives the isotonic calibration.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import Scratch, id_remainder, table

STATISTICS = (
    "log_bytes", "log_words", "bytes_per_word", "distinct_words", "repeated_next", "upper", "digits",
    "symbols", "pipes", "bangs", "beyond_ascii", "words_per_line", "distinct_lines",
)
FEATURES = 128
SEED = 42
UNIT = 1 << 12  # features are whole numbers of 1 / UNIT in the sums
PENALTY = 1e-4  # ridge penalty per row
BINS = 512  # of the raw score, for the calibration
RAW_LOW, RAW_HIGH = -0.5, 1.5
TIE_BREAK = 1e-3  # share of the raw score in the result, so that equal steps keep their order
THRESHOLD = 0.3


def statistics(data: bytes | None) -> list[float]:
    """The statistics of a UTF-8 text; all 0 for null and empty ones."""
    if not data:
        return [0.0] * len(STATISTICS)
    words = data.split()
    lines = data.split(b"\n")
    n, w = len(data), max(1, len(words))
    kinds = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters = max(1, int(kinds[65:91].sum() + kinds[97:123].sum()))
    marks = int(kinds[33:127].sum() - kinds[48:58].sum() - kinds[65:91].sum() - kinds[97:123].sum() - kinds[44] - kinds[46])
    return [
        float(np.log1p(n)),
        float(np.log1p(len(words))),
        min(n / w, 100.0),
        len(set(words)) / w,
        sum(map(eq, words, islice(words, 1, None))) / w,
        int(kinds[65:91].sum()) / letters,
        int(kinds[48:58].sum()) / n,
        marks / n,
        int(kinds[124]) / n,
        int(kinds[33]) / n,
        int(kinds[128:].sum()) / n,
        float(np.log1p(len(words) / len(lines))),
        len(set(lines)) / len(lines),
    ]


def text_statistics(text: Column) -> Column:
    @arrow_udf("array<double>")
    def of(batch: pa.Array) -> pa.Array:
        return pa.array([statistics(x.as_py()) for x in batch], pa.list_(pa.float64()))

    return of(text.cast("binary"))


@dataclass
class QualityModel:
    """Standardisation, feature directions, ridge weights and calibration steps."""

    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    raw: np.ndarray  # calibration points ...
    share: np.ndarray  # ... and their calibrated scores

    def features(self, stats: np.ndarray) -> np.ndarray:
        standard = np.clip((stats - self.mean) / self.spread, -8.0, 8.0)
        waves = np.cos(standard @ self.directions + self.phases) * np.sqrt(2.0)
        return np.concatenate([waves, np.ones((len(stats), 1))], axis=1)

    def raw_scores(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def scores(self, stats: np.ndarray) -> np.ndarray:
        raw = np.clip(self.raw_scores(stats), RAW_LOW, RAW_HIGH)
        calibrated = np.interp(raw, self.raw, self.share)
        return np.clip((1 - TIE_BREAK) * calibrated + TIE_BREAK * (raw - RAW_LOW) / (RAW_HIGH - RAW_LOW), 0.0, 1.0)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(len(column), len(STATISTICS))


def isotonic(values: list[float], weights: list[float]) -> list[float]:
    """The non-decreasing sequence nearest to the values in weighted squares (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for value, weight in zip(values, weights):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, n = blocks.pop()
            u, x, m = blocks[-1]
            blocks[-1] = [(u * x + v * w) / (x + w), x + w, m + n]
    return [v for v, _, n in blocks for _ in range(int(n))]


def _products(model: QualityModel):
    """A task's sums of feature products, as rows (i, j, total); column FEATURES + 1 is the label."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = FEATURES + 2
        total = np.zeros((size, size), np.int64)
        for batch in batches:
            if len(batch):
                z = np.concatenate([model.features(_matrix(batch[0])), np.array(batch[1].to_pylist(), float)[:, None]], axis=1)
                whole = np.rint(z * UNIT)
                total += np.rint(whole.T @ whole).astype(np.int64)  # a batch's sums stay below 2^53
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "total"])

    return task


def fit_quality(labelled: DataFrame, calibrates: Column, stats_col: str = "stats", label_col: str = "label") -> QualityModel:
    """Fit on all rows (stats, label 0 or 1); those where ``calibrates`` holds give the calibration only.

    With no rows every score is about 1, with one class about that class: nothing is rejected without
    evidence. Only sums reach the driver: of the statistics, of feature products and by score bin.
    """
    rows = labelled.select(F.col(stats_col).alias("stats"), F.col(label_col).cast("double").alias("label"), F.coalesce(calibrates, F.lit(False)).alias("calibrates"))
    moments = [f(F.get("stats", F.lit(k))) for k in range(len(STATISTICS)) for f in (F.avg, F.stddev_pop)]
    got = rows.agg(*moments, F.count("*"), F.avg("label")).first()
    mean = np.array([got[2 * k] or 0.0 for k in range(len(STATISTICS))])
    spread = np.array([got[2 * k + 1] or 1.0 for k in range(len(STATISTICS))])
    n, share = got[-2], 1.0 if got[-1] is None else float(got[-1])
    rng = np.random.default_rng(SEED)
    directions = rng.standard_normal((len(STATISTICS), FEATURES)) / np.sqrt(len(STATISTICS))
    model = QualityModel(mean, spread, directions, rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.array([RAW_LOW, RAW_HIGH]), np.array([share, share]))
    model.weights[-1] = share
    if share in (0.0, 1.0):
        return model
    sums = rows.filter("NOT calibrates").select("stats", "label").mapInArrow(_products(model), "i int, j int, total long")
    sums = sums.groupBy("i", "j").agg(F.sum("total").alias("total")).toPandas()
    gram = np.zeros((FEATURES + 2, FEATURES + 2))
    gram[sums.i, sums.j] = gram[sums.j, sums.i] = sums.total.to_numpy() / UNIT**2
    if gram[-2, -2]:
        model.weights = np.linalg.solve(gram[:-1, :-1] + PENALTY * gram[-2, -2] * np.eye(FEATURES + 1), gram[:-1, -1])

    @arrow_udf("int")
    def bin_of(stats: pa.Array) -> pa.Array:
        raw = np.clip(model.raw_scores(_matrix(stats)), RAW_LOW, RAW_HIGH)
        return pa.array(np.minimum((raw - RAW_LOW) * BINS / (RAW_HIGH - RAW_LOW), BINS - 1).astype(np.int32))

    binned = rows.filter("calibrates").groupBy(bin_of("stats").alias("bin")).agg(F.count("*").alias("n"), F.avg("label").alias("share"))
    binned = binned.orderBy("bin").toPandas()
    if len(binned):
        model.raw = RAW_LOW + (binned.bin.to_numpy() + 0.5) * (RAW_HIGH - RAW_LOW) / BINS
        model.share = np.array(isotonic(binned["share"].tolist(), binned["n"].tolist()))
    else:
        model.raw, model.share = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def quality_score(stats: Column, model: QualityModel, spark) -> Column:
    """The score, 0 to 1, of a column of statistics."""
    shared = spark.sparkContext.broadcast(model)

    @arrow_udf("double")
    def score(batch: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(_matrix(batch)))

    return score(stats)


def learn_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", stats_col: str = "stats") -> QualityModel:
    """Fit on the labelled rows whose id's crc32 is not divisible by 5; those with remainder 4 calibrate.

    Labels other than 0 and 1, null labels and null ids teach nothing. Where an id has several labels
    or rows, every pair is an example.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).filter(F.col("label").isin(0, 1))
    rest = id_remainder(F.col("id"), 5)
    rows = docs.select(F.col(id_col).alias("id"), F.col(stats_col).alias("stats")).join(known, "id").withColumn("fold", rest).filter("fold <> 0")
    scratch = Scratch(docs.sparkSession, "quality")
    model = fit_quality(scratch.write(rows.select("stats", "label", "fold"), "examples"), F.col("fold") == 4)
    scratch.drop("examples")
    return model


def op2_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # one pass over the texts: fitting and scoring both read the statistics
    stats = Scratch(spark, "quality").write(docs.select("doc_id", text_statistics(F.col("text")).alias("stats")), "stats")
    model = learn_quality(stats, table(spark, sf_dir, "labels"))
    scored = stats.select("doc_id", (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"), quality_score(F.col("stats"), model, spark).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
