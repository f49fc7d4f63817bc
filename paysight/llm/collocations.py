"""Phrase collocation mining by SETM: occurrence relations, merge-joined by piece and adjacent position.

The relation of length k holds, sorted by document and position, the word occurrences that lie in a
phrase of k words that may be frequent, and marks where such phrases begin. Positions skip a number
where a piece ends, so "next position" means "same piece and adjacent". One step extends it:

1. merge-join the relation with itself: where phrases of k words begin at a position and at the next,
   the two make one of k + 1;
2. group-count these, by a 64-bit key of each phrase, with a second hash and the place of one occurrence;
3. spell the frequent groups from that one place; groups of several phrases (their second hashes
   differ) are counted anew by their words;
4. semi-join: keep the occurrences whose group is frequent, and persist them as the next relation.

The relation is partitioned by document, so joins need no exchange, and what a task sends is one
count for each distinct phrase it saw. The semi-join asks a bit filter of a fixed largest size. A few
others pass it besides the frequent ones; the next count finds them out, so the filter never decides a
result. Words are numbered by hash, and the numbering is checked: no two words share a number.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paysight.runtime import SmallTable

from .common import Scratch, table

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
COVERED_PERCENT = 80
SCORE_UNIT = 2_000_000
UNKNOWN = "und"

CHUNK_BYTES = 1 << 20  # of a long text, cut where a piece ends
TOKENS_AT_ONCE = 1 << 17  # of texts, or of a relation's occurrences, laid end to end; a longer text's are taken together
FLUSH_WORDS = 1 << 18  # distinct words that a task counts before it hands them on
FLUSH_PHRASES = 1 << 20  # occurrences that a task gathers before it hands on their counts
CACHE_WORDS = 1 << 18
FILTER_BITS = (15, 28)  # least and largest size of the bit filter, as powers of two: 4 KiB to 32 MiB
BITS_PER_KEY = 16
PAGE_BITS = 1 << 15  # of a bitmap that one group of the aggregation makes
RANKED_ROWS = 1 << 17  # of one language that a task ranks

BREAK = b","  # ends a piece; it cannot stand in a word
BYTES = bytes(b + 32 if 65 <= b <= 90 else ord(BREAK) if chr(b) in ".,;:!?\n\x0b\x0c\r" else b for b in range(256))

RELATION = "row long, lang string, at array<int>, word array<long>, head array<boolean>"
HALF = (1 << 32) - 1
_GOLDEN, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def chunks(text: bytes | None) -> Iterator[list[bytes]]:
    """The words of a text, lower-cased (A-Z), with BREAK after every piece; a long text comes in several lists."""
    data, start = (text or b"").translate(BYTES), 0
    while start < len(data):
        stop = data.find(BREAK, start + CHUNK_BYTES)
        stop = len(data) if stop < 0 else stop
        yield [*data[start:stop].replace(BREAK, b" , ").split(), BREAK]
        start = stop + 1


def mix(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of a phrase and one more word (unsigned 64-bit)."""
    x = ((key << np.uint64(23)) ^ (key >> np.uint64(41)) ^ word) * _GOLDEN
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def second(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Like ``mix``, another function."""
    x = ((key >> np.uint64(27)) ^ (key << np.uint64(37)) ^ (word * _MIX)) * _GOLDEN
    return (x ^ (x >> np.uint64(31))) * _MIX


class Numbers(dict):
    """Words to numbers by hash; BREAK is 0."""

    def __init__(self, seed: int):
        self.seed = seed
        self[BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
            self[BREAK] = 0
        n = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return n


def _lang_keys(langs: list[str], seed: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(x.encode(), seed) for x in langs], np.uint64)


class BitFilter:
    """A set of 64-bit keys, two bits each: no key of the set is missed, a few others pass."""

    def __init__(self, bits: np.ndarray, power: int):
        self.bits, self.power = bits, power

    @classmethod
    def of(cls, keys: DataFrame, n: int) -> BitFilter:
        """From the column ``key`` of ``n`` rows. The bitmap's pages are made by Spark; at most 32 MiB reach the driver."""
        power = int(np.clip((BITS_PER_KEY * max(1, n) - 1).bit_length(), *FILTER_BITS))
        mask = F.lit((1 << power) - 1).cast("long")
        both = F.array(F.col("key").bitwiseAND(mask), F.shiftrightunsigned("key", 32).bitwiseAND(mask))
        places = keys.select(F.explode(both).alias("p"))
        pages = places.groupBy(F.shiftright("p", 15).alias("page")).agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit(PAGE_BITS - 1).cast("long"))).alias("m"))
        bits = np.zeros((1 << power) // 8, np.uint8)
        for r in pages.collect():
            at = r["page"] * PAGE_BITS // 8
            bits[at : at + PAGE_BITS // 8] = np.frombuffer(r["m"], np.uint8)
        return cls(bits, power)

    def has(self, keys: np.ndarray) -> np.ndarray:
        mask = np.uint64((1 << self.power) - 1)
        found = np.ones(len(keys), bool)
        for p in (keys & mask, (keys >> np.uint64(32)) & mask):
            found &= (self.bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def count_words(texts: DataFrame, seed: int) -> DataFrame:
    """(lang, word binary, w, key, n) of every distinct word of (lang string, text binary)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter[bytes]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counts in seen.items():
                del counts[BREAK]
                w = np.array([xxhash.xxh64_intdigest(x, seed) for x in counts], np.uint64)
                key = mix(np.broadcast_to(_lang_keys([lang], seed), w.shape), w)
                columns = [pa.array([lang] * len(w), pa.string()), pa.array(list(counts), pa.binary()), pa.array(w.view(np.int64)), pa.array(key.view(np.int64)), pa.array(list(counts.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "w", "key", "n"])
            seen.clear()

        for batch in batches:
            for lang, text in zip(batch[0].to_pylist(), batch[1]):
                own = seen.setdefault(lang, Counter())
                for words in chunks(text.as_py()):
                    own.update(words)
                if sum(map(len, seen.values())) > FLUSH_WORDS:
                    yield from flush()
        yield from flush()

    counted = texts.mapInArrow(task, "lang string, word binary, w long, key long, n long")
    return counted.groupBy("lang", "word", "w", "key").agg(F.sum("n").alias("n"))


def _numbered(texts: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """The word counts, and a seed by which no two words have one number (and none that of BREAK)."""
    seed = 42
    while True:
        words = scratch.write(count_words(texts, seed), f"words-{seed}")
        shared = words.groupBy("w").agg(F.min("word").alias("a"), F.max("word").alias("b")).filter("a <> b OR w = 0")
        if shared.isEmpty():
            return words, seed
        scratch.drop(f"words-{seed}")
        seed += 1


def _offsets(lengths: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())


def _relation(row: np.ndarray, langs: list[str], doc: np.ndarray, at: np.ndarray, word: np.ndarray, head: np.ndarray) -> pa.RecordBatch:
    """One row per document with an occurrence left."""
    own, lengths = np.unique(doc, return_counts=True)
    offsets = _offsets(lengths)
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (at.astype(np.int32), word.view(np.int64), head)]
    names = pa.array([langs[d] for d in own.tolist()], pa.string())
    return pa.RecordBatch.from_arrays([pa.array(row[own]), names, *lists], ["row", "lang", "at", "word", "head"])


def first_relation(texts: DataFrame, seed: int, kept: BitFilter, spark) -> DataFrame:
    """The occurrences of words that the filter lets through."""
    shared = spark.sparkContext.broadcast(kept)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers(seed)
        for batch in batches:
            row, langs = batch[0].to_numpy(), batch[1].to_pylist()
            keys = _lang_keys(langs, seed)
            waiting: list[bytes] = []
            runs: list[tuple[int, int, int]] = []  # document, its words before, words
            parts: list[tuple[np.ndarray, ...]] = []

            def encode() -> None:
                word = np.fromiter(map(numbers.__getitem__, waiting), np.uint64, len(waiting))
                doc = np.repeat([r[0] for r in runs], [r[2] for r in runs]).astype(np.int64)
                first = np.cumsum([0] + [r[2] for r in runs])[:-1]
                at = np.arange(len(word)) + np.repeat([r[1] for r in runs] - first, [r[2] for r in runs])
                some = np.flatnonzero((word != 0) & shared.value.has(mix(keys[doc], word)))
                parts.append((doc[some], at[some], word[some]))
                waiting.clear()
                runs.clear()

            def relation() -> pa.RecordBatch:
                encode()
                doc, at, word = (np.concatenate(x) for x in zip(*parts))
                parts.clear()
                return _relation(row, langs, doc, at, word, np.ones(len(doc), bool))

            for d, text in enumerate(batch[2]):
                before = 0
                for words in chunks(text.as_py()):
                    if len(waiting) > TOKENS_AT_ONCE:
                        encode()
                    runs.append((d, before, len(words)))
                    waiting += words
                    before += len(words)
                if sum(len(p[0]) for p in parts) + len(waiting) > TOKENS_AT_ONCE:
                    yield relation()  # whole documents
            yield relation()

    # one number per document, kept with the relation
    return texts.select(F.monotonically_increasing_id().alias("row"), "lang", "text").mapInArrow(task, RELATION)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches' documents, some at a time."""
    for batch in batches:
        ends, first = batch[2].offsets.to_numpy().astype(np.int64), 0
        while first < len(batch):
            stop = max(first + 1, int(np.searchsorted(ends, ends[first] + TOKENS_AT_ONCE, side="right")) - 1)
            yield batch.slice(first, stop - first)
            first = stop


class Occurrences:
    """Documents of a relation laid end to end."""

    def __init__(self, batch: pa.RecordBatch, seed: int):
        self.row, self.langs = batch[0].to_numpy(), batch[1].to_pylist()
        lengths = np.diff(batch[2].offsets.to_numpy())
        self.doc = np.repeat(np.arange(len(lengths)), lengths)
        self.at, self.word = batch[2].flatten().to_numpy(), batch[3].flatten().to_numpy().view(np.uint64)
        self.head = batch[4].flatten().to_numpy(zero_copy_only=False)
        self.lang_keys = _lang_keys(self.langs, seed)

    def joined(self) -> np.ndarray:
        """Where a phrase begins both here and at the next position of the piece: one word longer together."""
        if not len(self.at):
            return np.zeros(0, np.int64)
        next_to = (self.doc[1:] == self.doc[:-1]) & (self.at[1:] == self.at[:-1] + 1)
        return np.flatnonzero(self.head[:-1] & self.head[1:] & next_to)

    def keys(self, begin: np.ndarray, k: int, step=None) -> np.ndarray:
        key = self.lang_keys[self.doc[begin]]
        for j in range(k):
            key = (step or mix)(key, self.word[begin + j])
        return key

    def places(self, begin: np.ndarray) -> np.ndarray:
        """32 bits of where the occurrences stand."""
        return second(self.row[self.doc[begin]].view(np.uint64), self.at[begin].astype(np.uint64)) >> np.uint64(32)

    def words(self, begin: np.ndarray, k: int) -> np.ndarray:
        return np.stack([self.word[begin + j] for j in range(k)], axis=1)


def count_keys(relation: DataFrame, k: int, seed: int) -> DataFrame:
    """(key, n, low, high) of the phrases of k words that the relation of k - 1 words makes: low and high are the least and
    largest tag, 31 bits of the second hash above the 32 of a place."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def counted() -> pa.RecordBatch:
            key, tag = (np.concatenate(x) for x in zip(*held))
            held.clear()
            first, n = exact_groups(key, (tag >> np.uint64(32))[:, None], key)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (key[first], tag[first], n)], ["key", "tag", "n"])

        for batch in slices(batches):
            rows = Occurrences(batch, seed)
            begin = rows.joined()
            other = rows.keys(begin, k, second) >> np.uint64(33)
            held.append((rows.keys(begin, k), (other << np.uint64(32)) | rows.places(begin)))
            if sum(len(h[0]) for h in held) > FLUSH_PHRASES:
                yield counted()
        if held:
            yield counted()

    counted_keys = relation.mapInArrow(task, "key long, tag long, n long")
    return counted_keys.groupBy("key").agg(F.sum("n").alias("n"), F.min("tag").alias("low"), F.max("tag").alias("high"))


def spell(relation: DataFrame, k: int, seed: int, kept: BitFilter, places: BitFilter, spark) -> DataFrame:
    """(key, place, lang, words) of the phrases at the places that the filter lets through."""
    shared = spark.sparkContext.broadcast((kept, places))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = Occurrences(batch, seed)
            begin = rows.joined()
            key, place = rows.keys(begin, k), rows.places(begin)
            some = shared.value[0].has(key)
            begin, key, place = begin[some], key[some], place[some]
            some = np.flatnonzero(shared.value[1].has(key ^ (place << np.uint64(32) | place)))
            if len(some):
                words = rows.words(begin[some], k)
                lists = pa.ListArray.from_arrays(_offsets(np.full(len(some), k)), pa.array(words.ravel().view(np.int64)))
                names = pa.array([rows.langs[d] for d in rows.doc[begin[some]].tolist()], pa.string())
                columns = [pa.array(key[some].view(np.int64)), pa.array(place[some].view(np.int64)), names, lists]
                yield pa.RecordBatch.from_arrays(columns, ["key", "place", "lang", "words"])

    return relation.mapInArrow(task, "key long, place long, lang string, words array<long>")


def next_relation(relation: DataFrame, k: int, seed: int, kept: BitFilter, spark) -> DataFrame:
    """The occurrences within phrases of k words that the filter lets through."""
    shared = spark.sparkContext.broadcast(kept)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = Occurrences(batch, seed)
            begin = rows.joined()
            begin = begin[shared.value.has(rows.keys(begin, k))]
            if len(begin):
                head, within = np.zeros(len(rows.at), bool), np.zeros(len(rows.at), bool)
                head[begin] = True
                for j in range(k):
                    within[begin + j] = True
                yield _relation(rows.row, rows.langs, rows.doc[within], rows.at[within], rows.word[within], head[within])

    return relation.mapInArrow(task, RELATION)


def exact_groups(lang: np.ndarray, words: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row number of each distinct (lang, words), and how often it occurs; ``keys`` are equal for equal rows."""
    _, first, back, n = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    if (words[first][back] == words).all() and (lang[first][back] == lang).all():
        return first, n
    whole = np.concatenate([lang[:, None].astype(np.uint64), words], axis=1)  # two groups share a key
    _, first, n = np.unique(whole, axis=0, return_index=True, return_counts=True)
    return first, n


def count_phrases(relation: DataFrame, k: int, seed: int, kept: BitFilter, spark) -> DataFrame:
    """(lang, words, n) of the phrases of k words, of the relation of k - 1 words, that the filter lets through."""
    shared = spark.sparkContext.broadcast(kept)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, int] = {}
        held: list[tuple[np.ndarray, ...]] = []

        def counted() -> pa.RecordBatch:
            lang, words, keys = (np.concatenate(x) for x in zip(*held))
            held.clear()
            first, n = exact_groups(lang, words, keys)
            names = list(numbers)
            lists = pa.ListArray.from_arrays(_offsets(np.full(len(first), k)), pa.array(words[first].ravel().view(np.int64)))
            return pa.RecordBatch.from_arrays([pa.array([names[i] for i in lang[first].tolist()], pa.string()), lists, pa.array(n, pa.int64())], ["lang", "words", "n"])

        for batch in slices(batches):
            rows = Occurrences(batch, seed)
            begin = rows.joined()
            begin = begin[shared.value.has(rows.keys(begin, k))]
            own = np.array([numbers.setdefault(x, len(numbers)) for x in rows.langs], np.int64)
            held.append((own[rows.doc[begin]], rows.words(begin, k), rows.keys(begin, k)))
            if sum(len(h[0]) for h in held) > FLUSH_PHRASES:
                yield counted()
        if held:
            yield counted()

    return relation.mapInArrow(task, "lang string, words array<long>, n long").groupBy("lang", "words").agg(F.sum("n").alias("n"))


def frequent_phrases(texts: DataFrame, scratch: Scratch, min_count: int, max_words: int) -> tuple[DataFrame, DataFrame]:
    """All word counts (lang, word, w, n), and (lang, words, n) of every phrase of 1 to max_words words that occurs min_count times.

    ``texts`` has the columns lang (string, not null) and text (binary).
    """
    spark = texts.sparkSession
    words, seed = _numbered(texts, scratch)
    often = words.filter(F.col("n") >= min_count)
    found = [often.select("lang", F.array("w").alias("words"), "n")]
    relation = scratch.write(first_relation(texts, seed, BitFilter.of(often, often.count()), spark), "relation-1")
    for k in range(2, max_words + 1):
        keys = scratch.write(count_keys(relation, k, seed).filter(F.col("n") >= min_count), f"keys-{k}")
        one = F.shiftright("low", 32) == F.shiftright("high", 32)
        n, n_one = keys.agg(F.count("*"), F.count_if(one)).first()
        if not n:
            break
        kept = BitFilter.of(keys, n)
        place = F.col("low").bitwiseAND(F.lit(HALF))
        single = keys.filter(one).select("key", "n", place.alias("place"))
        mark = F.col("key").bitwiseXOR(F.shiftleft("place", 32).bitwiseOR(F.col("place")))
        spelled = spell(relation, k, seed, kept, BitFilter.of(single.select(mark.alias("key")), 2 * n_one), spark)
        phrases = single.join(spelled, ["key", "place"]).dropDuplicates(["key"]).select("lang", "words", "n")
        if n_one < n:
            mixed = keys.filter(~one)
            counted = count_phrases(relation, k, seed, BitFilter.of(mixed, n - n_one), spark).filter(F.col("n") >= min_count)
            phrases = phrases.unionByName(counted).groupBy("lang", "words").agg(F.max("n").alias("n"))
        found.append(scratch.write(phrases, f"phrases-{k}"))
        if k < max_words:
            relation = scratch.write(next_relation(relation, k, seed, kept, spark), f"relation-{k}")
            scratch.drop(f"relation-{k - 1}", f"keys-{k}")
    return words, scratch.write(reduce(DataFrame.unionAll, found), "phrases")


def _whole(x: Column) -> Column:
    return x.cast("decimal(20,0)")


def scored_candidates(phrases: DataFrame) -> DataFrame:
    """(lang, words, a, l, r, score) of every phrase of several words, by its lowest cut (ties to the first)."""
    several = phrases.filter(F.size("words") > 1).withColumnRenamed("n", "a")
    cut = several.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cut = cut.withColumn("head", F.expr("slice(words, 1, k)")).withColumn("tail", F.expr("slice(words, k + 1, size(words) - k)"))
    part = lambda name, n: phrases.select("lang", F.col("words").alias(name), F.col("n").alias(n))
    both = cut.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"])
    score = F.expr(f"(CAST({SCORE_UNIT} AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0))) DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    lowest = both.groupBy("lang", "words", "a").agg(F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("best"))
    return lowest.select("lang", "words", "a", "best.l", "best.r", "best.score")


def not_covered(candidates: DataFrame, percent: int = COVERED_PERCENT) -> DataFrame:
    """Without those that lie inside a longer candidate which occurs at least ``percent`` % as often."""
    inner = "flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), s -> slice(words, s, m))))"
    longer = candidates.filter(F.size("words") > 2).select("lang", F.explode(F.expr(inner)).alias("words"), "a")
    most = longer.groupBy("lang", "words").agg(F.max("a").alias("longer"))
    covered = _whole(F.col("longer")) * 100 >= _whole(F.col("a")) * percent
    return candidates.join(most, ["lang", "words"], "left").filter(~F.coalesce(covered, F.lit(False))).drop("longer")


def _above_cut(candidates: DataFrame, top: int) -> DataFrame:
    """The candidates of each language whose score reaches that of its top-th: a histogram of scores, at most SCORE_UNIT / 2 + 1 a language."""
    counts = candidates.groupBy("lang", "score").agg(F.count("*").alias("n"))
    above = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("score"))) - F.col("n")
    cut = counts.withColumn("above", above).filter(F.col("above") < top).groupBy("lang").agg(F.min("score").alias("least"))
    return candidates.join(SmallTable(cut).for_join(), "lang").filter("score >= least").drop("least")


def _spelled(candidates: DataFrame, words: DataFrame) -> DataFrame:
    """With the column ``phrase``: the words joined by a space."""
    each = candidates.select("lang", "words", F.posexplode("words").alias("place", "w"))
    named = each.join(words.select("lang", "w", F.col("word").cast("string").alias("word")), ["lang", "w"])
    text = named.groupBy("lang", "words").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("s"))
    return candidates.join(text.select("lang", "words", F.concat_ws(" ", F.col("s.word")).alias("phrase")), ["lang", "words"])


def ranked(candidates: DataFrame, top: int, scratch: Scratch, rows: int = RANKED_ROWS) -> DataFrame:
    """The first ``top`` of each language by score, a and phrase, with their rank. A language of very many rows is
    ranked in parts of about ``rows``, whose first ``top`` meet again, so no task ranks more."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    current, step = scratch.write(candidates, "ranked-0"), 0
    while (most := current.groupBy("lang").count().agg(F.max("count")).first()[0] or 0) > max(rows, 4 * top):
        part = F.pmod(F.xxhash64("words", F.lit(step)), F.lit(-(-most // rows) + 1))
        window = Window.partitionBy("lang", "part").orderBy(*order)
        step += 1
        fewer = current.withColumn("part", part).withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= top)
        current = scratch.write(fewer.drop("part", "rank"), f"ranked-{step}")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return current.withColumn("rank", rank).filter(F.col("rank") <= top)


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    top: int = TOP,
    percent: int = COVERED_PERCENT,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language.

    A phrase of 2 to max_words words that occurs a >= min_count times within pieces scores
    floor(2000000 a / (l + r)) at its lowest cut (ties to the first); it falls out if its words lie in a longer
    candidate that occurs at least ``percent`` % as often. Ranks follow score, a (both falling) and phrase (UTF-8 bytes). A null
    language is ``und``; null, empty and blank texts have no words; texts of any length are taken whole; repeated
    rows count as often as they occur. An empty table, or one without such phrases, gives an empty
    result. Other columns of ``docs``, whatever their names, are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "collocations")
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("string").cast("binary").alias("text"))
    words, phrases = frequent_phrases(texts, scratch, min_count, max_words)
    scores = scratch.write(not_covered(scored_candidates(phrases), percent), "scored")
    best = _spelled(_above_cut(scores, top), words.filter(F.col("n") >= min_count))
    totals = SmallTable(words.groupBy("lang").agg(F.sum("n").alias("n")))
    out = ranked(best, top, scratch).join(totals.for_join(), "lang")
    scratch.drop(*(f"{name}-{k}" for name in ("relation", "phrases", "keys") for k in range(1, max_words + 1)), "phrases", "scored")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, '{UNKNOWN}') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)
), places AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM pieces CROSS JOIN range(1, {MAX_WORDS + 1}) t(m) WHERE len(w) >= m
), f AS (SELECT lang, m, phrase, CAST(count(*) AS HUGEINT) AS a FROM places GROUP BY lang, m, phrase
), totals AS (SELECT lang, sum(a) AS n FROM f WHERE m = 1 GROUP BY lang
), candidates AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND a >= {MIN_COUNT}
), cuts AS (
  SELECT c.*, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:m], ' ') AS tail
  FROM candidates c CROSS JOIN range(1, {MAX_WORDS}) t(k) WHERE k < m
), scored AS (
  SELECT c.lang, c.m, c.phrase, c.a, k, x.a AS l, y.a AS r, {SCORE_UNIT} * c.a // (x.a + y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.tail
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_phrases AS (
  SELECT lang, array_to_string(w[s:s + i - 1], ' ') AS phrase, max(a) AS longer
  FROM candidates CROSS JOIN range(2, {MAX_WORDS}) t(i) CROSS JOIN range(1, {MAX_WORDS}) u(s)
  WHERE i < m AND s + i - 1 <= m GROUP BY ALL
), best AS (
  SELECT lowest.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest LEFT JOIN inner_phrases USING (lang, phrase) WHERE longer IS NULL OR NOT 100 * longer >= {COVERED_PERCENT} * a
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM best JOIN totals USING (lang) WHERE rank <= {TOP}
"""
