"""Near duplicates by SimHash, with pigeonring filtering of the candidates.

A 64-bit fingerprint is cut into ``max_bits + 1`` consecutive segments on a ring. If two
fingerprints differ in at most ``max_bits`` bits, some segment starts a chain all of whose
prefixes stay within their proportional budgets: no difference in the first segment, at most one in
the first two, at most two in the first three, and so on. So a pair is a candidate only where

* it shares a bucket: the first segment equal and the second within one bit (each fingerprint
  enters the bucket of its own two segments, and, for each zero bit of the second, the bucket with
  that bit set), and
* the rest of the chain stays within its budgets.

Only then are all 64 bits compared. Copies collapse to one fingerprint first. Buckets are worked
on in batches of rows; each hands on a spanning star of every set it linked, never all of a
bucket's pairs. Crowded buckets are split into blocks and every two blocks meet in a task of
their own, so no task holds more than a bounded part of a bucket and no pair is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from paysight.runtime import SmallTable

from .common import Scratch, fresh, table
from .components import connected_components

BITS = 64
SEED = 42
SHINGLES_AT_ONCE = 1 << 15
PAIRS_AT_ONCE = 1 << 20
BLOCK_ROWS = 4096  # rows of a bucket in one task's block
TASK_ROWS = 1 << 20  # bucket rows dealt to one task, about
GROUP_ROWS = 1 << 17  # of them held at a time, with the rest of the last group
NO_ID = (1 << 63) - 1


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """SimHash of the word shingles of a UTF-8 text, repeats included, as a signed 64-bit number.

    bytes.lower() changes A-Z only and bytes.split() cuts at the ASCII white space only, which is
    what the contract asks for. A text with fewer words than a shingle is one shingle; none gives 0.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        last = len(words) - shingle + 1
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[:last].tolist(), ends[shingle - 1 :].tolist())]
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), SHINGLES_AT_ONCE):
        some = np.array(hashes[k : k + SHINGLES_AT_ONCE], np.uint64).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def simhash(text: Column, shingle: int = 4) -> Column:
    @arrow_udf("long")
    def of(batch: pa.Array) -> pa.Array:
        return pa.array([fingerprint(x.as_py(), shingle) for x in batch], pa.int64())

    return of(text.cast("binary"))


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the max_bits + 1 segments, as even as 64 bits allow."""
    n = max_bits + 1
    cuts = [BITS * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _bits(value: Column, low: int, width: int) -> Column:
    shifted = F.shiftrightunsigned(value, low)
    return shifted if width == BITS else shifted.bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def bucket_rows(classes: DataFrame, max_bits: int) -> DataFrame:
    """(bucket, own, fp, rep): for each segment the own bucket and those with one more bit of the next."""
    parts = segments(max_bits)
    entries = []
    for i, (low, width) in enumerate(parts):
        next_low, next_width = parts[(i + 1) % len(parts)]
        first, second = _bits(F.col("fp"), low, width), _bits(F.col("fp"), next_low, next_width)
        for bit in [None, *range(next_width)] if len(parts) > 1 else [None]:
            flip = 0 if bit is None else 1 << bit
            # the segment's number above its bits: buckets of different segments never meet
            value = F.shiftleft(first, 26).bitwiseXOR(second.bitwiseXOR(F.lit(flip).cast("long")))
            bucket = F.xxhash64(F.lit(i), value) if width + next_width > 52 else value + F.lit(i << 56).cast("long")
            emit = F.lit(True) if bit is None else second.bitwiseAND(F.lit(flip).cast("long")) == 0
            entries.append(F.when(emit, F.struct(bucket.alias("bucket"), F.lit(bit is None).alias("own"))))
    return classes.select("fp", "rep", F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")).select(
        "e.bucket", "e.own", "fp", "rep"
    )


def within_chain(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs have a ring start whose every chain prefix is within budget (signed 64-bit inputs)."""
    parts = segments(max_bits)
    diff = (a ^ b).view(np.uint64)
    per = [np.bitwise_count((diff >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int16) for low, width in parts]
    found = np.zeros(len(a), bool)
    for start in range(len(parts)):
        total, fits = np.zeros(len(a), np.int16), np.ones(len(a), bool)
        for length in range(1, len(parts)):  # the whole ring is the Hamming check
            total = total + per[(start + length - 1) % len(parts)]
            fits &= total <= max_bits * length // len(parts)
        found |= fits
    return found


def within(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    near = np.flatnonzero(within_chain(a, b, max_bits))
    return near[np.bitwise_count((a[near] ^ b[near]).view(np.uint64)) <= max_bits]


def fold(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of a[i] and b[i] in place; label[x] is a smaller or equal member of x's set."""
    while len(a):
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low != high
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def link_buckets(max_bits: int):
    """Of a task's rows (bucket, block pair, own, fp, rep): stars over the fingerprints linked in any bucket."""

    def stars(rows: pa.Table) -> pa.RecordBatch:
        group, own, fp, rep = (rows[c].to_numpy() for c in ("meet", "own", "fp", "rep"))
        order = np.lexsort((~own, group))
        group, own, fp, rep = group[order], own[order], fp[order], rep[order]
        node, at = np.unique(fp, return_index=True)
        rep = rep[at]
        label, local = np.arange(len(node)), np.searchsorted(node, fp)
        ends = np.searchsorted(group, group, side="right")
        partners = np.where(own, ends - np.arange(len(group)) - 1, 0)
        total = np.cumsum(partners)
        row = 0
        while row < len(group):  # owners meet the owners after them and the visitors of their bucket
            stop = max(row + 1, int(np.searchsorted(total, total[row] - partners[row] + PAIRS_AT_ONCE, side="right")))
            n = partners[row:stop]
            a = np.repeat(np.arange(row, stop), n)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
            hit = within(fp[a], fp[b], max_bits)
            fold(label, local[a[hit]], local[b[hit]])
            row = stop
        up = np.flatnonzero(label != np.arange(len(node)))
        to = label[up]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (node[up], rep[up], node[to], rep[to])], ["fp", "rep", "fp2", "rep2"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows come sorted by what they meet in; whole groups are worked on, some at a time."""
        held: pa.Table | None = None
        for batch in batches:
            more = pa.Table.from_batches([batch])
            held = more if held is None else pa.concat_tables([held, more])
            if len(held) >= GROUP_ROWS:
                meet = held["meet"].to_numpy()
                last = int(np.searchsorted(meet, meet[-1]))  # where the group that may go on begins
                if last:
                    yield stars(held.slice(0, last))
                    held = held.slice(last)
        if held is not None and len(held):
            yield stars(held)

    return task


def bucket_tasks(n_classes: int, extra: int, max_bits: int) -> int:
    """Tasks for the bucket rows of ``n_classes`` fingerprints and the ``extra`` rows that crowded buckets' blocks add."""
    per_class = len(segments(max_bits)) + BITS // 2
    return max(8, (n_classes * per_class + extra) // TASK_ROWS + 1)


def dealt_rows(classes: DataFrame, max_bits: int, n_classes: int) -> DataFrame:
    """The bucket rows with the group (``meet``) in which they are compared: a bucket, or two blocks of a crowded one. Dealt
    by group to as many tasks as there are rows for, and sorted by it."""
    rows = bucket_rows(classes, max_bits)
    crowded = SmallTable(
        rows.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > BLOCK_ROWS).select("bucket", "n", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    )
    extra = 0
    if crowded.rows:
        extra = crowded.df.agg(F.sum(F.col("n") * (F.col("blocks") - 1))).first()[0]
        rows = rows.join(crowded.for_join().drop("n"), "bucket", "left")
    else:
        rows = rows.withColumn("blocks", F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int")
    rows = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    meet = F.when(F.coalesce("blocks", F.lit(1)) == 1, F.col("bucket")).otherwise(
        F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other"))
    )
    return rows.select(meet.alias("meet"), "own", "fp", "rep").repartition(bucket_tasks(n_classes, extra, max_bits), "meet").sortWithinPartitions("meet")


def links(classes: DataFrame, max_bits: int, n_classes: int) -> DataFrame:
    """Edges (u, v) of structs (rep, fp): same components as all pairs within ``max_bits``."""
    dealt = dealt_rows(classes, max_bits, n_classes)
    found = dealt.mapInArrow(link_buckets(max_bits), "fp long, rep long, fp2 long, rep2 long")
    return found.select(F.struct("rep", "fp").alias("u"), F.struct(F.col("rep2").alias("rep"), F.col("fp2").alias("fp")).alias("v"))


def components(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int, key: Column | None = None) -> DataFrame:
    """(id, key, fp, component): component is the struct (rep, fp) of the least fingerprint class reachable."""
    if not 0 <= max_bits <= 31:
        raise ValueError("max_bits must be from 0 to 31")
    scratch = Scratch(docs.sparkSession, "simhash")
    key = F.lit(None).cast("string") if key is None else key
    prints = scratch.write(docs.select(F.col(id_col).alias("id"), key.alias("key"), simhash(F.col(text_col), shingle).alias("fp")), "prints")
    classes = scratch.write(
        prints.groupBy("fp").agg(F.coalesce(F.min("id").cast("long"), F.lit(NO_ID)).alias("rep")), "classes"
    )
    n_classes = classes.count()
    found = connected_components(links(classes, max_bits, n_classes), scratch)
    found = found.select(F.col("node.fp").alias("fp"), F.col("root").alias("root"))
    # its own table, so that the join below deals both sides anew and can split a crowded fingerprint
    roots = classes.join(found, "fp", "left").select("fp", F.coalesce("root", F.struct("rep", "fp")).alias("component"))
    return prints.join(scratch.write(roots, "roots"), "fp").select("id", "key", "fp", "component")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4
) -> DataFrame:
    """One row per row of ``docs``: (id_col, fp long, component_id).

    Rows link where their fingerprints differ in at most ``max_bits`` (0 to 31) bits; component_id is
    the smallest id reachable. Null and empty texts have fingerprint 0 and link like any other.
    Null ids never become a component_id; a component without any id gets null. Repeated rows
    come out as often as they went in. Other columns of ``docs`` are ignored.
    """
    found = components(docs, id_col, text_col, shingle, max_bits)
    return found.select(F.col("id").alias(id_col), "fp", F.nullif(F.col("component.rep"), F.lit(NO_ID)).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, null ids last, then of the smallest text digest.

    The columns stay as they are. Of rows equal in id and text one is kept.
    """
    row = F.md5(F.concat_ws(" ", F.coalesce(F.col(id_col).cast("string"), F.lit("none")), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))).cast("binary"))
    name = fresh(docs, "_row")
    found = components(docs, id_col, text_col, shingle, max_bits, row)
    first = F.min(F.struct(F.coalesce(F.col("id").cast("long"), F.lit(NO_ID)), "key"))
    winners = found.groupBy("component").agg(first.alias("w")).select(F.col("w.key").alias(name))
    return docs.withColumn(name, row).join(winners, name, "left_semi").dropDuplicates([name]).select(*docs.columns)


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def op7_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")
