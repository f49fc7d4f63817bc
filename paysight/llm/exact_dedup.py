"""Exact duplicates by an extendible-hash index on shared files, in DataFrame functions only.

Every text gets a 64-bit hash. The index holds the hashes that occur more than once, in buckets: a
bucket is a range of hash values, those that share their first ``depth`` bits. Starting at the depth
that the load makes certain, every overfull bucket is split by the next bit (the directory
doubles) and its keys move to the next level's files, until each bucket fits its owner's bounds or
holds a single key. A key whose copies alone are more than a bucket's load has overflow pages: its
copies are merged page by page, before anything of them is sent to the owner.

Owner tasks get whole buckets and compare bytes: texts of one hash form a chain with one link for
each distinct text, so a collision of hashes only makes a longer chain. A row finds its link by its
hash, or, where the chain has several, by hash and text. All tables are Parquet in the folder that
``spark.checkpoint.dir`` names, so a lost executor costs tasks, not steps.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paysight.runtime import SmallTable

from .common import Scratch, table

BUCKET_BYTES = 16 << 20  # what an owner reads of one bucket
KEY_BYTES = 64  # what a key itself counts for
MAX_PAGES = 64  # of one key; its copies are merged within them
MAX_OWNERS = 1 << 15  # tasks; beyond that a task owns several buckets
HASH_BITS = 64

# A run of white space, or one that is no blank: the single blanks between words stay as they are.
SPACES = "[\\x20\\x09-\\x0D]{2,}|[\\x09-\\x0D]"


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def _prefix(h: Column, depth: int) -> Column:
    return F.shiftrightunsigned(h, HASH_BITS - depth) if depth else F.lit(0).cast("long")


def build_index(keys: DataFrame, scratch: Scratch, capacity: int = BUCKET_BYTES) -> tuple[DataFrame, int]:
    """(depth, bucket, h, pages) of every key of (h, n, n_bytes), and the number of buckets.

    No bucket's load is above ``capacity`` unless it has one key.
    """
    copies = F.col("n") * F.greatest("n_bytes", F.lit(1))
    pages = F.least(F.ceil(copies / capacity), F.lit(MAX_PAGES)).cast("int")
    load = KEY_BYTES + F.when(pages > 1, pages * F.col("n_bytes")).otherwise(copies)
    left = keys.select("h", pages.alias("pages"), load.alias("load"))
    total = left.agg(F.sum("load")).first()[0] or 0
    depth = max(0, math.ceil(math.log2(max(1, total) / capacity)))
    levels, buckets = [], 0
    while True:
        slots = left.withColumn("depth", F.lit(depth)).withColumn("bucket", _prefix(F.col("h"), depth))
        loads = slots.groupBy("bucket").agg(F.sum("load").alias("bucket_load"), F.count("*").alias("bucket_keys"))
        level = scratch.write(slots.join(loads, "bucket"), f"level-{depth}")
        full = (F.col("bucket_load") > capacity) & (F.col("bucket_keys") > 1) & F.lit(depth < HASH_BITS)
        levels.append(level.filter(~full).select("depth", "bucket", "h", "pages"))
        n_full, n_buckets = level.agg(
            F.coalesce(F.sum(full.cast("int")), F.lit(0)), F.coalesce(F.sum(F.when(~full, 1 / F.col("bucket_keys"))), F.lit(0.0))
        ).first()
        buckets += round(n_buckets)
        if not n_full:
            return reduce(DataFrame.unionAll, levels), buckets
        left, depth = level.filter(full).select("h", "pages", "load"), depth + 1


def chains(texts: DataFrame, buckets: int) -> DataFrame:
    """(h, norm, keep, n, links) of every distinct text of (depth, bucket, h, pages, norm, id); links is its chain's length."""
    one = texts.filter("pages = 1").select("depth", "bucket", "h", "norm", F.col("id").alias("keep"), F.lit(1).cast("long").alias("n"))
    page = F.pmod(F.spark_partition_id(), F.col("pages"))
    paged = texts.filter("pages > 1").withColumn("page", page).groupBy("depth", "bucket", "page", "h", "norm")
    merged = paged.agg(F.min("id").alias("keep"), F.count("*").alias("n")).drop("page")
    owned = one.unionByName(merged).repartition(max(1, min(buckets, MAX_OWNERS)), "depth", "bucket")
    links = owned.groupBy("depth", "bucket", "h", "norm").agg(F.min("keep").alias("keep"), F.sum("n").alias("n"))
    return links.withColumn("links", F.count("*").over(Window.partitionBy("depth", "bucket", "h"))).drop("depth", "bucket")


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = BUCKET_BYTES,
    key: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per row of ``docs``: (id_col, keep_id, group_size, kept, text_sha256).

    Texts are equal when their bytes are after ``normalised``; null and empty texts equal each other, and
    a text of white space only equals one space. keep_id is the least id among equal texts, null only where none of them has
    one; kept says whether the row's id is it, so rows repeated with one id are all kept or all
    dropped, and rows without an id are kept only where no equal text has one. Texts of any length are
    compared whole. An empty table gives an empty result. Other columns of ``docs``, whatever their names,
    are ignored. ``key`` is the hash (a long); a poor one costs time, never a wrong result.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    norm = normalised(F.col(text_col))
    texts = docs.select(F.col(id_col).alias("id"), norm.alias("norm")).withColumn("h", key(F.col("norm")))
    entries = scratch.write(texts.select("id", "h", F.octet_length("norm").alias("n_bytes"), F.sha2("norm", 256).alias("sha")), "entries")
    keys = entries.groupBy("h").agg(F.count("*").alias("n"), F.max("n_bytes").cast("long").alias("n_bytes")).filter("n > 1")
    index, buckets = build_index(scratch.write(keys, "keys"), scratch, capacity)

    indexed = SmallTable(index)
    pages = scratch.write(texts.join(indexed.for_join(), "h"), "pages")
    links = scratch.write(chains(pages, buckets).withColumn("norm", F.when(F.col("links") > 1, F.col("norm"))), "links")
    scratch.drop("pages", "keys")

    groups = SmallTable(links.filter("links = 1").select("h", "keep", "n"))
    rows = entries
    collided = links.filter("links > 1")
    several = SmallTable(collided.select("h").distinct())
    if several.rows:
        rows = rows.join(several.for_join(), "h", "left_anti")
    rows = rows.join(groups.for_join(), "h", "left").select("id", "sha", "n", F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep")).alias("keep"))
    if several.rows:
        again = texts.join(several.for_join(), "h").join(collided.select("h", "norm", "keep", "n"), ["h", "norm"])
        rows = rows.unionByName(again.select("id", F.sha2("norm", 256).alias("sha"), "n", "keep"))
    return rows.select(
        F.col("id").alias(id_col),
        F.col("keep").alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def op11_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), groups AS (
  SELECT norm, min(doc_id) AS keep_id, CAST(count(*) AS BIGINT) AS group_size FROM texts GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM texts JOIN groups USING (norm)
"""
