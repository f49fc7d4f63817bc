"""Exact top-k inner products by ball trees, branch and bound.

Vectors are dealt into shards of a bounded number of rows, queries into blocks of a bounded number;
each (shard, block) pair is one group. Its task builds a ball tree over the shard and takes each
query through the leaves in order of their upper bound <q, centre> + |q| radius, until the bound
falls below the query's current kth score. That score starts at the kth best among the queries of
the block itself (they are candidates like any other row), so all shards share it without any
exchange, and it rises from leaf to leaf. Ties are kept until the shards' results are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, table

SHARD_ROWS = 8192
BLOCK_QUERIES = 1024
LEAF_ROWS = 128
K = 5


class BallTree:
    """Leaves of a tree that halves its rows along the direction of their widest spread."""

    def __init__(self, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.leaves, self.centres, self.radii = [], [], []
        todo = [np.arange(len(vectors))]
        while todo:
            rows = todo.pop()
            part = vectors[rows]
            centre = part.mean(axis=0)
            away = np.linalg.norm(part - centre, axis=1)
            if len(rows) <= leaf_rows or away.max() == 0:
                self.leaves.append(rows)
                self.centres.append(centre)
                self.radii.append(away.max())
                continue
            far = part[away.argmax()]
            other = part[np.linalg.norm(part - far, axis=1).argmax()]
            order = np.argsort(part @ (far - other), kind="stable")
            todo += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)

    def upper_bounds(self, queries: np.ndarray) -> np.ndarray:
        """For every query and leaf, no less than any inner product in the leaf (with a margin for rounding)."""
        size = np.linalg.norm(queries, axis=1)
        bound = queries @ self.centres.T + size[:, None] * self.radii[None, :]
        scale = size.max(initial=0) * (np.linalg.norm(self.centres, axis=1).max(initial=0) + self.radii.max(initial=0))
        return bound + 1e-9 * scale + 1e-6


def _exact(vectors: np.ndarray) -> np.ndarray:
    """Integers as a type in which sums of their products are exact: doubles, long or Python's own."""
    largest = float(np.abs(vectors).max(initial=0))
    product = largest * largest * max(1, vectors.shape[1])
    if product < 2**53:
        return vectors
    return vectors.astype(np.int64) if product < 2**62 else np.array([[int(x) for x in v] for v in vectors], object)


def _kth(scores: list, k: int):
    return sorted(scores, reverse=True)[k - 1] if len(scores) >= k else None


def search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> pd.DataFrame:
    """Of each query the k best rows of this shard, and all that tie with the kth, unless they cannot be among its overall k best."""
    tree = BallTree(vectors)
    bounds = tree.upper_bounds(queries)
    both = _exact(np.concatenate([vectors, queries]))
    exact, asked = both[: len(vectors)], both[len(vectors) :]
    seeds = asked @ asked.T
    out = []
    for q in range(len(queries)):
        floor = _kth(seeds[q][query_ids != query_ids[q]].tolist(), k)
        best_scores, best_ids = [], []
        for leaf in np.argsort(-bounds[q], kind="stable").tolist():
            if floor is not None and bounds[q][leaf] < floor:
                break
            rows = tree.leaves[leaf]
            rows = rows[ids[rows] != query_ids[q]]
            scores = exact[rows] @ asked[q]
            good = slice(None) if floor is None else scores >= floor
            best_scores += scores[good].tolist()
            best_ids += ids[rows[good]].tolist()
            if len(best_scores) >= k:
                floor = _kth(best_scores, k) if floor is None else max(floor, _kth(best_scores, k))
        order = sorted(range(len(best_ids)), key=lambda i: (-best_scores[i], best_ids[i]))[:k]
        out += [(int(query_ids[q]), int(best_ids[i]), int(best_scores[i])) for i in order]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def top_k(
    rows: DataFrame,
    is_query,
    id_col: str = "vec_id",
    vector_col: str = "vector",
    k: int = K,
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank from 1, vec_id, score) of the k largest integer inner products of each query.

    ``vector_col`` holds doubles with integer values; ``is_query`` is a boolean column over ``rows``.
    Ties go to the smaller id. Candidates are all rows of the same dimension but those with the
    query's own id, repeated rows as often as they occur; a query that repeats in id and vector is asked
    once. Rows with a null id, a null vector or a null or non-finite component take no part. Queries without candidates give no rows. Other columns are ignored.
    """
    v = F.col(vector_col)
    sound = v.isNotNull() & F.forall(v, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    clean = rows.filter(F.col(id_col).isNotNull()).filter(sound)
    clean = clean.select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("row"))
    clean = Scratch(rows.sparkSession, "topk").write(clean, "vectors")
    n, asking = clean.agg(F.count("*"), F.count_if("asks")).first()
    shards, blocks = int(n) // shard_rows + 1, int(asking) // block_queries + 1
    # every query is also a candidate; a row meets each block as a candidate and each shard as a query
    # and copies of a row are dealt apart by their numbers, which never change once written
    spread = lambda parts, *by: F.pmod(F.xxhash64(*by), F.lit(parts))
    upto = lambda parts: F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))
    candidates = clean.select("id", "vector", F.lit(False).alias("asks"), spread(shards, "row").alias("shard"), F.explode(upto(blocks)).alias("block"))
    queries = clean.filter("asks").select("id", "vector", "asks").distinct()
    queries = queries.select("id", "vector", "asks", F.explode(upto(shards)).alias("shard"), spread(blocks, "id", "vector").alias("block"))

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf["asks"].to_numpy()
        if asks.all() or not asks.any():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        vectors = np.stack(pdf["vector"].to_numpy())
        ids = pdf["id"].to_numpy()
        return search(ids[~asks], vectors[~asks], ids[asks], vectors[asks], k)

    found = (
        candidates.union(queries)
        .withColumn("dim", F.size("vector"))
        .groupBy("shard", "block", "dim")
        .applyInPandas(meet, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def quantised(embedding: Column) -> Column:
    """floor(256 x) of every component, as whole doubles; non-finite components stay so."""
    scaled = lambda x: F.lit(256.0) * x.cast("double")
    # floor gives a long, which is too short beyond 2^53; whole doubles are their own floor there
    small = lambda x: F.abs(x) < F.lit(float(1 << 53))
    return F.transform(embedding, lambda x: F.when(small(scaled(x)), F.floor(scaled(x)).cast("double")).otherwise(scaled(x)))


def op10_topk_search(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    vectors = rows.select("vec_id", quantised(F.col("embedding")).alias("vector"))
    return top_k(vectors, F.col("vec_id") % 50 == 0)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
