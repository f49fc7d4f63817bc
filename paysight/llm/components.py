"""Connected components over an edge table, by alternating large and small stars.

Every round is a few shuffles keyed by node, aggregated before the shuffle, and ends in a written
table. A node with very many neighbours is only ever an aggregation key (partial sums) or a key of
an equi-join that adaptive execution may split; no task gathers a node's neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysight.runtime import SmallTable

from .common import Scratch


HUB_EDGES = 256  # a node with more of them is a hub


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """``edges`` with the ``m`` of their ``u``. Hubs (n > HUB_EDGES), which would crowd a task, come by a join of their own:
    a broadcast if they are few, else one that adaptive execution may split; all others by a shuffle join."""
    hubs = SmallTable(least.filter(F.col("n") > HUB_EDGES).select("u", F.col("m").alias("hub_m")))
    if not hubs.rows:
        return edges.join(least.drop("n"), "u")
    marked = edges.join(hubs.for_join(), "u", "left")
    of_hubs = marked.filter("hub_m IS NOT NULL").select("u", "v", F.col("hub_m").alias("m"))
    others = marked.filter("hub_m IS NULL").drop("hub_m").join(least.filter(F.col("n") <= HUB_EDGES).drop("n"), "u")
    return of_hubs.unionByName(others.select("u", "v", "m"))


def _large_star(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Link every larger neighbour of a node to the least node around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = scratch.write(both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"), F.count("*").alias("n")), name)
    return _with_least(both.filter("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them. Edges run from u to v < u."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "star") -> DataFrame:
    """(u, v) pairs of any orderable type to (node, root): root is the least node reachable.

    Loops and repeated edges are harmless; nodes without a proper edge get no row. Stops at the
    first round that changes nothing, which is when every edge points at its component's root.
    """
    current = scratch.write(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        f"{name}-0",
    )
    seen, k = None, 0
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen is not None and tuple(state) == seen or state[0] == 0:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(state)
        k += 1
        large = _large_star(current, scratch, f"{name}-least-{k}").distinct()
        current = scratch.write(_small_star(large).distinct(), f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}", f"{name}-least-{k}")
