"""Benchmark decontamination: a broadcast hash set of the test texts' word windows.

Test items are normalised to words and cut into windows of 13 words (an item of fewer words is one
window). The windows' hashes, sorted, and the items' words go to every task as flat arrays of bounded size; training
texts are scanned whole. All windows of a text are hashed at once, those that pass a bit filter are searched among
the sorted hashes, and a hit compares the whole window, word for word. Test sets above a stated size are
scanned for in blocks of that size, one after the other, so what a task holds stays bounded.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from xxhash import xxh64_intdigest

from .common import WORD_BYTES, Scratch, fresh, table

WINDOW = 13
MAX_BLOCK_BYTES = 16 << 20  # test text and ids in one broadcast block; at most 11 times that in memory
HASH_STEP = np.uint64(0x9E3779B97F4A7C15)
# A document is contaminated if at least one word in so many is hit.
CONTAMINATED_SHARE = 20

SPANS = "array<struct<first_word:int,last_word:int,first_byte:int,end_byte:int>>"
SCAN = f"struct<n_words:long,spans:{SPANS},items:array<string>>"
_SPANS = pa.list_(pa.struct([(n, pa.int32()) for n in ("first_word", "last_word", "first_byte", "end_byte")]))
_SCAN = pa.struct([("n_words", pa.int64()), ("spans", _SPANS), ("items", pa.list_(pa.string()))])


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` words, from the words' hashes."""
    n = len(words) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(size if n > 0 else 0):
        out = out * HASH_STEP + words[j : j + n]
    return out


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


class WindowTable:
    """The windows of one size: sorted hashes, the first word of each, and a bit filter over the hashes' first bits."""

    def __init__(self, hashes: np.ndarray, firsts: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.firsts = hashes[order], firsts[order]
        self.shift = np.uint64(64 - max(10, (16 * len(hashes) - 1).bit_length()))
        bits = np.unique(self.hashes >> self.shift)
        self.filter = np.zeros(1 << (61 - int(self.shift)), np.uint8)
        np.bitwise_or.at(self.filter, (bits >> np.uint64(3)).astype(np.int64), (1 << (bits & np.uint64(7))).astype(np.uint8))

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Where in ``hashes`` one of the table's stands."""
        bits = hashes >> self.shift
        may = np.flatnonzero(self.filter[(bits >> np.uint64(3)).astype(np.int64)] >> (bits & np.uint64(7)).astype(np.uint8) & 1)
        at = np.minimum(np.searchsorted(self.hashes, hashes[may]), len(self.hashes) - 1)
        return may[self.hashes[at] == hashes[may]]

    def run(self, value: np.uint64) -> np.ndarray:
        """The first words of all windows with this hash."""
        low, high = np.searchsorted(self.hashes, value), np.searchsorted(self.hashes, value, "right")
        return self.firsts[low:high]


class Windows:
    """The windows of a block of test items, and where they occur in a text.

    All of it is flat arrays: the items' words as one text, where each word begins (4 bytes a word), and of each window its
    hash, its first word (12 bytes) and up to 4 bytes of filter. As a word and its separator take two
    bytes, that is at most 11 bytes for each byte of test text, and the ids.
    """

    def __init__(self, items: list[tuple[str, str]], width: int = WINDOW):
        flat, lengths, first_words, ids = bytearray(), array("I"), array("I"), []
        hashes: dict[int, array] = defaultdict(lambda: array("Q"))
        firsts: dict[int, array] = defaultdict(lambda: array("I"))
        for item_id, text in items:
            words = text.encode().translate(WORD_BYTES).split()
            if not words:
                continue
            size, begin = min(width, len(words)), len(lengths)
            ids.append(item_id)
            first_words.append(begin)
            flat += b" ".join(words) + b" "
            lengths.extend(map(len, words))
            own = window_hashes(word_hashes(words), size)
            hashes[size].frombytes(own.tobytes())
            firsts[size].frombytes(np.arange(begin, begin + len(own), dtype=np.uint32).tobytes())
        self.ids = pa.array(ids, pa.string())
        self.first_words = np.frombuffer(first_words, np.uint32)
        self.text = bytes(flat)
        ends = np.cumsum(np.frombuffer(lengths, np.uint32) + 1, dtype=np.int64)
        self.begins = np.concatenate(([0], ends)).astype(np.uint32)
        self.tables = {size: WindowTable(np.frombuffer(hashes[size], np.uint64), np.frombuffer(firsts[size], np.uint32)) for size in sorted(hashes)}
        self.mixed = {size: self._mixed(size, table) for size, table in self.tables.items()}

    def _mixed(self, size: int, table: WindowTable) -> set[int]:
        """The hashes that windows of different words share."""
        again = np.flatnonzero(table.hashes[1:] == table.hashes[:-1]).tolist()
        return {int(table.hashes[k]) for k in again if self._words(table.firsts[k], size) != self._words(table.firsts[k + 1], size)}

    def _words(self, first, size: int) -> bytes:
        return self.text[self.begins[first] : self.begins[int(first) + size] - 1]

    @property
    def nbytes(self) -> int:
        arrays = [self.first_words, self.begins, *(x for t in self.tables.values() for x in (t.hashes, t.firsts, t.filter))]
        return len(self.text) + self.ids.nbytes + sum(x.nbytes for x in arrays)

    def _owners(self, size: int, value: np.uint64, gram: bytes) -> np.ndarray:
        """The items, by number, in which this window stands, compared word for word."""
        firsts = self.tables[size].run(value)
        if int(value) in self.mixed[size]:
            firsts = np.array([f for f in firsts if self._words(f, size) == gram], np.uint32)
        elif self._words(firsts[0], size) != gram:
            firsts = firsts[:0]
        return np.unique(np.searchsorted(self.first_words, firsts, "right") - 1)

    def scan(self, data: bytes) -> dict:
        flat = data.translate(WORD_BYTES)
        words = flat.split()
        n = len(words)
        hashes = word_hashes(words)
        hits: list[tuple[int, int]] = []
        items: list[np.ndarray] = []
        for size, table in self.tables.items():
            own = window_hashes(hashes, size)
            known: dict[bytes, bool] = {}
            for k in table.holds(own).tolist():
                gram = b" ".join(words[k : k + size])
                if gram not in known:
                    owners = self._owners(size, own[k], gram)
                    known[gram] = len(owners) > 0
                    items.append(owners)
                if known[gram]:
                    hits.append((k, k + size - 1))
        spans = merged(hits)
        if spans:
            bounds = [m.span() for m in re.finditer(rb"[^ ]+", flat)]
            spans = [(a, b, bounds[a][0], bounds[b][1]) for a, b in spans]
        found = {self.ids[k].as_py() for k in np.unique(np.concatenate(items)).tolist()} if items else set()
        return {"n_words": n, "spans": [dict(zip(_SPANS.value_type.names, s)) for s in spans], "items": sorted(found)}


def merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or adjoining word intervals as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(hits):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scanner(spark, items: list[tuple[str, str]], width: int):
    shared = spark.sparkContext.broadcast(Windows(items, width))

    @arrow_udf(SCAN)
    def scan(text: pa.Array) -> pa.Array:
        windows = shared.value
        return pa.array([windows.scan(x.as_py() or b"") for x in text], _SCAN)

    return scan


def _merge_spans(spans: pa.Array) -> pa.Array:
    out = []
    for one in spans.to_pylist():
        first = {s["first_word"]: s["first_byte"] for s in one}
        end = {s["last_word"]: s["end_byte"] for s in one}
        out.append([dict(zip(_SPANS.value_type.names, (a, b, first[a], end[b]))) for a, b in merged([(s["first_word"], s["last_word"]) for s in one])])
    return pa.array(out, _SPANS)


def test_blocks(benchmark: DataFrame, id_col: str, text_col: str, max_bytes: int) -> list[DataFrame]:
    """The test items in blocks of about ``max_bytes`` of text and ids; null ids and texts are left out."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("body")).dropna()
    size = items.agg(F.sum(F.octet_length("body") + F.octet_length("item"))).first()[0] or 0
    n = int(size // max_bytes) + 1
    return [items.filter(F.pmod(F.xxhash64("item", "body"), F.lit(n)) == k) if n > 1 else items for k in range(n)]


def scan_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WINDOW,
    max_block_bytes: int = MAX_BLOCK_BYTES,
    scan_col: str = "scan",
) -> DataFrame:
    """``docs`` with a struct column: n_words, the hit spans (words and bytes) and the items found.

    Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z. Null and empty texts have no
    words and no spans. Items whose id or text is null, or that have no words, match nothing; items
    with the same windows are all found. Very long texts are scanned whole, in memory that grows with the text by a few
    words' numbers each; there are no ties. An empty table of documents gives no rows, an empty test set no spans. Rows, their order of columns and repeats stay as they are.
    A column of ``docs`` named like ``scan_col`` is replaced.
    """
    spark = docs.sparkSession
    blocks = test_blocks(benchmark, item_col, item_text_col, max_block_bytes)
    body = F.col(text_col).cast("binary")
    if len(blocks) == 1:  # the whole test set is proven to fit one block
        items = [(r["item"], r["body"]) for r in blocks[0].collect()]
        return docs.withColumn(scan_col, _scanner(spark, items, width)(body))
    scratch = Scratch(spark, "decontaminate")
    out = docs.withColumn(scan_col, F.lit(None).cast(SCAN))
    for k, block in enumerate(blocks):
        items = [(r["item"], r["body"]) for r in block.collect()]
        more_col = fresh(out, "_more")
        out = out.withColumn(more_col, _scanner(spark, items, width)(body))
        before, more = F.col(scan_col), F.col(more_col)
        both = F.when(before.isNull(), more).otherwise(
            F.struct(
                more["n_words"].alias("n_words"),
                F.concat(before["spans"], more["spans"]).alias("spans"),
                F.array_sort(F.array_union(before["items"], more["items"])).alias("items"),
            )
        )
        out = scratch.write(out.withColumn(scan_col, both).drop(more_col), f"block-{k}")
        if k:
            scratch.drop(f"block-{k - 1}")
    return out.withColumn(scan_col, F.col(scan_col).withField("spans", arrow_udf(_merge_spans, SPANS)(F.col(scan_col)["spans"])))


def words_hit(scan: Column) -> Column:
    return F.aggregate(
        scan["spans"], F.lit(0).cast("long"), lambda n, s: n + s["last_word"] - s["first_word"] + F.lit(1).cast("long")
    )


def is_contaminated(scan: Column) -> Column:
    hit = words_hit(scan)
    return (hit > 0) & (CONTAMINATED_SHARE * hit >= scan["n_words"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without its contaminated rows, columns unchanged."""
    scan = fresh(docs, "_scan")
    scanned = scan_documents(docs, benchmark, text_col, scan_col=scan, **options)
    return scanned.filter(~is_contaminated(F.col(scan))).select(*docs.columns)


def _cut(text: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for data, found in zip(text.to_pylist(), spans.to_pylist()):
        for s in reversed(found or []):
            data = data[: s["first_byte"]] + data[s["end_byte"] :]
        out.append(None if data is None else data.decode())
    return pa.array(out, pa.string())


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the hit passages cut out of their texts, columns unchanged; null texts stay null."""
    scan = fresh(docs, "_scan")
    scanned = scan_documents(docs, benchmark, text_col, scan_col=scan, **options)
    spans = F.col(scan)["spans"]
    cut = F.when(F.size(spans) > 0, arrow_udf(_cut, "string")(F.col(text_col).cast("binary"), spans)).otherwise(F.col(text_col))
    return scanned.withColumn(text_col, cut).select(*docs.columns)


def op8_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scan = F.col("scan")
    return scan_documents(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        scan["n_words"].alias("n_words"),
        words_hit(scan).alias("n_hit"),
        F.size(scan["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(scan["items"], ","), 256).alias("items_sha256"),
        is_contaminated(scan).alias("contaminated"),
    )


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP8_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[k : k + least(13, len(w)) - 1], ' ') AS gram
  FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
  SELECT rid, size, k, array_to_string(w[k : k + size - 1], ' ') AS gram
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT g.rid, g.k, g.size, windows.item FROM grams g JOIN windows USING (size, gram)),
hit_words AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(k, k + size)) AS p FROM hits) GROUP BY rid),
hit_items AS (SELECT rid, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words h USING (rid) LEFT JOIN hit_items i USING (rid)
"""
