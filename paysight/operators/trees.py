"""Boosted trees as tables and arrays: a way to evaluate them beside MLlib's own.

A saved ensemble is read as a table of nodes (a few numbers per node, so as large as the model, never as the data). Laid
end to end in arrays it routes whole batches of rows through every tree to their leaves, one step down at a time. From the
leaves follow the predictions, and sums per (tree, leaf) over the training rows tell whether each leaf's value follows
from them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_DEPTH = 30  # the deepest tree MLlib grows
LEAF = -1  # child of a node that has none
BLOCK = 2048  # rows routed at a time, whose features stay in a core's cache


def tree_nodes(spark: SparkSession, path: str) -> DataFrame:
    """(tree, weight, node, value, n_fitted, left, right, feature, cuts, categories) of a saved ensemble.

    ``n_fitted`` counts the (sampled) rows a node was fitted on. ``cuts`` is the threshold of a node whose
    ``categories`` is -1, else the category numbers that go left. Leaves have -1 as children.
    """
    node, split = F.col("nodeData"), F.col("nodeData.split")
    nodes = spark.read.parquet(f"{path.rstrip('/')}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        node["prediction"].alias("value"),
        node["rawCount"].cast("long").alias("n_fitted"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        split["featureIndex"].alias("feature"),
        split["leftCategoriesOrThreshold"].alias("cuts"),
        split["numCategories"].alias("categories"),
    )
    weights = spark.read.parquet(f"{path.rstrip('/')}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    return nodes.join(weights, "tree")


class Forest:
    """The trees in order, their nodes laid end to end; ``first`` is the place of each tree's root."""

    def __init__(self, nodes: DataFrame):
        rows = nodes.orderBy("tree", "node").collect()  # of the model's size
        column = lambda name, kind: np.array([r[name] for r in rows], kind)
        self.tree, self.node, self.value, self.weight = column("tree", np.int32), column("node", np.int32), column("value", float), column("weight", float)
        self.first = np.flatnonzero(np.diff(self.tree, prepend=-1))
        root = np.repeat(self.first, np.diff(np.append(self.first, len(rows))))
        # a leaf is its own child, so rows that reached it stay
        own, left, right = np.arange(len(rows)), column("left", np.int64), column("right", np.int64)
        self.left, self.right = np.where(left == LEAF, own, root + left), np.where(left == LEAF, own, root + right)
        self.children = np.stack([self.left, self.right], axis=1).ravel()  # of node k: left at 2 k, right after it
        inner = left != LEAF
        self.feature = np.where(inner, column("feature", np.int64), 0)
        categories = np.where(inner, column("categories", np.int64), -1)
        self.cut = np.array([r["cuts"][0] if i and c < 0 else 0.0 for r, i, c in zip(rows, inner, categories)])
        # categorical nodes: their row in a table of the categories that go left, else -1
        self.categorical = np.where(categories >= 0, np.cumsum(categories >= 0) - 1, -1)
        self.goes_left = np.zeros(((categories >= 0).sum(), max(1, categories.max(initial=0))), bool)
        for k in np.flatnonzero(categories >= 0):
            self.goes_left[self.categorical[k], np.array(rows[k]["cuts"], np.int64)] = True

    def leaves(self, x: np.ndarray, depth: int) -> np.ndarray:
        """The place of the leaf that each row of ``x`` reaches, trees by rows."""
        out = np.empty((len(self.first), len(x)), np.int64)
        for begin in range(0, len(x), BLOCK):
            part = np.ascontiguousarray(x[begin : begin + BLOCK])
            rows, flat = np.arange(len(part)) * part.shape[1], part.ravel()
            for k, root in enumerate(self.first):
                at = np.full(len(part), root)
                for _ in range(depth):
                    own = flat.take(self.feature.take(at) + rows)
                    left = own <= self.cut.take(at)
                    if len(self.goes_left):
                        kind = self.categorical[at]
                        some = np.flatnonzero(kind >= 0)
                        left[some] = self._in_set(kind[some], own[some])
                    at = self.children.take(2 * at + ~left)
                out[k, begin : begin + len(part)] = at
        return out

    def _in_set(self, kind: np.ndarray, own: np.ndarray) -> np.ndarray:
        known = (own >= 0) & (own < self.goes_left.shape[1])
        number = np.where(known, own, 0).astype(np.int64)
        return known & (number == own) & self.goes_left[kind, number]


def _matrix(features: pa.Array) -> np.ndarray:
    """Rows by slots of an array column; a null row is one of NaN, which goes right everywhere."""
    values, valid = np.asarray(features.flatten(), float), features.is_valid().to_numpy(zero_copy_only=False)
    out = np.full((len(features), len(values) // max(1, valid.sum())), np.nan)
    out[valid] = values.reshape(valid.sum(), -1)
    return out if out.shape[1] else np.full((len(features), 1), np.nan)


def route(df: DataFrame, nodes: DataFrame, features: str = "features", depth: int = MAX_DEPTH) -> DataFrame:
    """``df`` with ``parts``: for each tree in order the struct (tree, leaf, part), part being the leaf's value times
    the tree's weight. ``depth`` is at least that of the deepest tree."""
    forest = Forest(nodes)

    @F.arrow_udf("array<struct<tree int, leaf int, part double>>")
    def parts(x: pa.Array) -> pa.Array:
        at = forest.leaves(_matrix(x), depth).T.ravel()
        fields = {"tree": forest.tree[at], "leaf": forest.node[at], "part": forest.weight[at] * forest.value[at]}
        ends = np.arange(len(x) + 1, dtype=np.int32) * len(forest.first)
        return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(v) for v in fields.values()], list(fields)))

    return df.withColumn("parts", parts(vector_to_array(features)))


def boosted_prediction(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda total, p: total + p["part"])


def leaf_audit(train: DataFrame, nodes: DataFrame, features: str = "features", label: str = "label", depth: int = MAX_DEPTH) -> DataFrame:
    """One row per (tree, leaf): whether its value follows from the training rows that reach it.

    The first tree fits the labels, every later one the steepest descent of the squared error, 2 (label - prediction
    so far). A leaf's value is the mean of these over the ``n_fitted`` rows that were sampled among its ``n``. Whatever the
    sample, such a mean lies within sd sqrt((n - m) / m) of the mean of all (``within``); over many leaves its squared distance, in units
    of its sampling variance, is about 1 on average (``z2``; null where nothing was left out or all rows are equal).
    A leaf that no row reaches is not within.
    """
    forest = Forest(nodes)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(forest.tree)
        n, off, square = np.zeros(size, np.int64), np.zeros(size), np.zeros(size)
        for batch in batches:
            y, before = np.asarray(batch.column("y"), float), np.zeros(batch.num_rows)
            for k, at in enumerate(forest.leaves(_matrix(batch.column("x")), depth)):
                target = 2 * (y - before) if k else y
                # counted from the leaf's value, so equal targets leave no variance
                d = target - forest.value[at]
                n += np.bincount(at, minlength=size)
                off += np.bincount(at, d, size)
                square += np.bincount(at, d * d, size)
                before += forest.weight[at] * forest.value[at]
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(c[some]) for c in (forest.tree, forest.node, n, off, square)], ["tree", "node", "n", "off", "square"])

    rows = train.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    sums = rows.mapInArrow(task, "tree int, node int, n long, off double, square double").groupBy("tree", "node").agg(*[F.sum(c).alias(c) for c in ("n", "off", "square")])
    moved = F.col("off") / F.col("n")
    leaves = nodes.filter(F.col("left") == LEAF).select("tree", "node", "value", "n_fitted")
    leaves = leaves.join(sums, ["tree", "node"], "left").select(
        *leaves.columns, "n", (F.col("value") + moved).alias("mean"), F.greatest(F.col("square") / F.col("n") - moved * moved, F.lit(0.0)).alias("var")
    )
    n, m, off = F.col("n"), F.col("n_fitted"), F.abs(F.col("value") - F.col("mean"))
    rounding = 1e-9 * (1 + F.abs("value"))
    within = (m <= n) & (off <= F.sqrt(F.col("var") * F.greatest(n - m, F.lit(0)) / m) + rounding)
    z2 = F.when((m < n) & (F.col("var") > 1e-12), off * off * m * (n - 1) / (F.col("var") * (n - m)))
    return leaves.select("*", F.coalesce(within, F.lit(False)).alias("within"), z2.alias("z2"))


def audit_holds(audit: DataFrame, most_z2: float = 4.0) -> DataFrame:
    """One row (leaves, leaves_follow, mean_z2): every leaf within its bound, and no more spread than sampling gives.

    Splits are chosen on the sampled rows, which pushes the mean of z2 somewhat above 1.
    """
    mean_z2 = F.avg("z2")
    return audit.agg(
        F.count("*").alias("leaves"),
        (F.every("within") & (F.coalesce(mean_z2, F.lit(0.0)) <= most_z2)).alias("leaves_follow"),
        mean_z2.alias("mean_z2"),
    )
