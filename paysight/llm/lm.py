"""Language-model scoring with Elias-Fano n-gram tries.

The model keeps every token, pair and triple of the training texts, however rare. Tasks put the texts
of about a million tokens into a chunk and number its distinct tokens. Each chunk sends its distinct
n-grams with their training counts to shards, once each, and gets one answer per n-gram back:

1. Tokens go to the shard of their hash, which adds up their counts and numbers them.
2. Pairs and triples go, as those numbers, to the shard of their context; n-grams of contexts that
   occur very often are spread by their last word too. A shard adds up the counts, puts its n-grams
   into an Elias-Fano trie, mapped into memory, and answers by successor search within each context.

So no n-gram is sent more than once per chunk, however often it occurs, nothing is broadcast, and a
shard holds about a fixed number of n-grams whatever the corpus. Chunks themselves move once, without the
texts of their tokens, to meet their answers; asking for n-grams and scoring read them from there.

A trie stores quantised log10 probabilities c(n-gram) / N. The share of the lower order depends on the
context's count C alone, ``share``, so that an n-gram's probability needs no other n-gram:
p(w | context) = (1 - share(C)) * c(context, w) / C + share(C) * p(w | shorter context). Order 3; the
unigrams are the base score's, (c + 1) / (N + V + 1). The probabilities of all words sum to one, but
for the quantisation. Tokens and counts are compared as they are, never by hash.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, id_remainder, table
from .elias_fano import Trie

CHUNK = 1 << 20  # tokens after which a chunk is closed; a longer text is in one chunk
SHARD = 1 << 20  # tokens of all texts per shard
SPREAD = 1 << 16  # a word that occurs more often may be part of a context that is spread over shards
END = b""  # no word is empty
ABSENT = 1.0  # no log10 probability

ANSWER = "chunk long, level int, shard int, data array<binary>, seen long"


def tokens_of(data: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, and the end."""
    return [*(data or b"").lower().split(), END]


def share(count: np.ndarray) -> np.ndarray:
    """The lower order's share in a context that occurs ``count`` times: new words get rarer as it does."""
    return np.where(count > 0, 0.75 * np.maximum(count, 1.0) ** -0.25, 1.0)


def squeeze(values: np.ndarray) -> bytes:
    """Whole numbers from 0 up in as few bytes as the largest needs, byte by byte, compressed."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    planes = np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(-1, kind.itemsize).T
    return _compress(np.ascontiguousarray(planes).tobytes(), kind.itemsize)  # many times as fast as tobytes of the view


def unsqueeze(data: bytes) -> np.ndarray:
    raw, size = _decompress(data)
    planes = np.frombuffer(raw, np.uint8).reshape(size, -1).T
    return np.ascontiguousarray(planes).view(f"<u{size}").ravel().astype(np.int64)


def _compress(raw: bytes, mark: int = 0, level: int = 1) -> bytes:
    return bytes([mark]) + len(raw).to_bytes(8, "little") + pa.Codec("zstd", level).compress(raw, asbytes=True)


def _decompress(data: bytes) -> tuple[bytes, int]:
    return pa.decompress(data[9:], int.from_bytes(data[1:9], "little"), codec="zstd", asbytes=True), data[0]


def _join(words: Iterator[bytes]) -> bytes:
    return _compress(b" ".join(words), level=3)  # text gains from it, numbers do not


def _split(data: bytes) -> list[bytes]:
    return _decompress(data)[0].split(b" ")


def gaps_of(words: list[np.ndarray]) -> list[np.ndarray]:
    """Sorted n-grams, a column per place, as differences: each word from the one before it where all words to its left are the same."""
    out, same = [], np.ones(len(words[0]), bool)
    same[:1] = False
    for word in words:
        before = np.roll(word, 1)
        out.append(word - np.where(same, before, 0))
        same = same & (word == before)
    return out


def words_of(gaps: list[np.ndarray]) -> list[np.ndarray]:
    """What :func:`gaps_of` was given."""
    out, same = [], np.ones(len(gaps[0]), bool)
    same[:1] = False
    for gap in gaps:
        total = np.cumsum(gap)
        first = np.flatnonzero(~same)
        word = total - np.repeat(total[first] - gap[first], np.diff(np.append(first, len(gap))))
        out.append(word)
        same = same & (word == np.roll(word, 1))
    return out


def token_shards(tokens: list[bytes], shards: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, tokens), np.int64, len(tokens)) % shards


def chunks_of(texts: DataFrame) -> DataFrame:
    """Chunks of a frame (text binary, trains boolean, doc struct): one row each, with its docs and their tokens' numbers."""
    docs_type = T.ArrayType(texts.schema["doc"].dataType)
    schema = T.StructType([T.StructField("docs", docs_type), *[T.StructField(c, T.BinaryType()) for c in ("ids", "lengths", "trains", "tokens")]])
    schema.add("n", "long").add("n_train", "long").add("texts", "long")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, ids, trains, numbers = [], [], [], defaultdict()

        def fresh_numbers() -> None:
            numbers.clear()
            numbers.default_factory = numbers.__len__
            numbers[END]

        def closed() -> pa.RecordBatch:
            rows = pa.concat_arrays(docs)
            lengths = np.array([len(x) for x in ids])
            flags = np.array(trains, bool)
            row = [pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)]
            laid = np.concatenate(ids)
            by_count = np.argsort(-np.bincount(laid), kind="stable")  # small numbers for frequent tokens take less room
            rank = np.empty(len(by_count), np.int64)
            rank[by_count] = np.arange(len(by_count))
            names = list(numbers)
            names = _join(names[k] for k in by_count.tolist())
            row += [pa.array([x], pa.binary()) for x in (squeeze(rank[laid]), squeeze(lengths), squeeze(flags), names)]
            row += [pa.array([int(x)], pa.int64()) for x in (lengths.sum(), lengths[flags].sum(), flags.sum())]
            for held in (docs, ids, trains):
                held.clear()
            fresh_numbers()
            return pa.RecordBatch.from_arrays(row, schema.names)

        fresh_numbers()
        size = 0
        for batch in batches:
            first = 0
            for k, (text, flag) in enumerate(zip(batch.column("text"), batch.column("trains").to_pylist()), 1):
                own = tokens_of(text.as_py())
                ids.append(np.fromiter(map(numbers.__getitem__, own), np.int32, len(own)))
                trains.append(flag)
                size += len(own)
                if size >= CHUNK:
                    docs.append(batch.column("doc").slice(first, k - first))
                    yield closed()
                    first, size = k, 0
            if first < batch.num_rows:
                docs.append(batch.column("doc").slice(first))
        if ids:
            yield closed()

    return texts.mapInArrow(task, schema)


class Chunk:
    """A chunk's tokens, of each the shard, and, once the token shards have answered, their counts and numbers in the model."""

    def __init__(self, row: dict, token_shard: np.ndarray, shards: int):
        self.shards, self.size = shards, len(token_shard)
        self.ids, self.lengths = unsqueeze(row["ids"]), unsqueeze(row["lengths"])
        self.flags = np.repeat(unsqueeze(row["trains"]) > 0, self.lengths)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.order = np.argsort(token_shard, kind="stable")
        self.shard = token_shard[self.order]

    def token_requests(self, tokens: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
        n = np.bincount(self.ids[self.flags], minlength=self.size)
        every = np.bincount(self.ids, minlength=self.size)
        for shard, part in _parts(self.shard):
            own = self.order[part]
            yield shard, [_join(tokens[k] for k in own.tolist()), squeeze(n[own]), squeeze(every[own])]

    def learn(self, answers: list[list[bytes]], texts: int) -> None:
        """Take the token shards' answers, in order of the shards. The word that begins each text comes after all others."""
        got = [np.concatenate([unsqueeze(a[k]) for a in answers]) for k in range(3)]
        full = [np.empty(self.size + 1, np.int64) for _ in got]
        for whole, values, begin in zip(full, got, (texts, 1, 1)):
            whole[self.order] = values
            whole[-1] = begin  # its number is 0, one less than what is sent
        self.count, self.number, self.often = full[0], full[1] - 1, full[2] > 0
        before = np.roll(self.ids, 1)
        before[self.starts] = self.size
        self.before = before
        size, number = self.size + 1, self.number
        known = (number[before] >= 0) & (number[self.ids] >= 0)
        self.pairs = _Grams(before * size + self.ids, known, self.flags, shards=self.shards)
        v, w = np.divmod(self.pairs.keys, size)
        rank = np.empty(size, np.int64)
        rank[np.argsort(number, kind="stable")] = np.arange(size)
        self.pairs.send([number[v], number[w]], self.often[v], rank[v], rank[w])
        # a triple is the pair of the place before and its own word
        prior = np.roll(self.pairs.at, 1)
        prior[self.starts] = -1
        self.prior = prior
        self.triples = _Grams(prior * size + self.ids, (prior >= 0) & known, self.flags, shards=self.shards)
        pair, w = np.divmod(self.triples.keys, size)
        u, v = np.divmod(self.pairs.keys[pair], size)
        self.triples.send([number[u], number[v], number[w]], self.often[u] & self.often[v], rank[u] * size + rank[v], rank[w])

    def gram_requests(self) -> Iterator[tuple[int, int, list[bytes]]]:
        for level, grams in ((2, self.pairs), (3, self.triples)):
            for shard, part in _parts(grams.shard):
                own = grams.order[part]
                # ranks follow the numbers, so these are sorted
                yield level, shard, [*map(squeeze, gaps_of([c[own] for c in grams.words])), squeeze(grams.n[own])]

    def scores(self, pairs: list[bytes], triples: list[bytes], n: int, v: int) -> tuple[np.ndarray, ...]:
        """Of each text: tokens, known ones, base score and score, from the shards' answers in order of the shards."""
        p1 = (self.count[self.ids] + 1.0) / (n + v + 1)
        two, three = self.pairs.counts(pairs, n), self.triples.counts(triples, n)
        p2 = _mixed(two, self.count[self.before].astype(float), p1)
        context = np.where(self.prior >= 0, two[np.maximum(np.arange(len(two)) - 1, 0)], 0.0)
        p3 = _mixed(three, context, p2)
        per_token = (np.ones(len(p1), np.int64), (self.count[self.ids] > 0).astype(np.int64), np.log10(p1), np.log10(p3))
        return tuple(np.add.reduceat(x, self.starts) for x in per_token)


def _mixed(n: np.ndarray, context: np.ndarray, lower: np.ndarray) -> np.ndarray:
    part = share(context)
    # counts are coded, so an n-gram can come out a little above its context
    return (1 - part) * np.minimum(n / np.maximum(context, 1e-300), 1.0) + part * lower


def _parts(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The runs of equal shards in a sorted array."""
    turns = np.flatnonzero(np.diff(shard, prepend=-1))
    for a, b in zip(turns.tolist(), [*turns[1:].tolist(), len(shard)]):
        yield int(shard[a]), slice(a, b)


class _Grams:
    """A chunk's distinct n-grams of one order: keys, training counts, and at each place the key's position (or -1)."""

    def __init__(self, key: np.ndarray, known: np.ndarray, flags: np.ndarray, shards: int):
        self.shards = shards
        self.keys, back = np.unique(key[known], return_inverse=True)
        self.n = np.bincount(back[flags[known]], minlength=len(self.keys))
        self.at = np.full(len(key), -1, np.int64)
        self.at[known] = back

    def send(self, words: list[np.ndarray], spread: np.ndarray, context: np.ndarray, last: np.ndarray) -> None:
        """Order the n-grams by shard, context and last word; both come as ranks that follow their numbers."""
        mixed = np.zeros(len(self.keys), np.uint64)
        for k, word in enumerate(words):
            step = _scramble(mixed ^ word.astype(np.uint64))
            mixed = np.where(spread, step, mixed) if k == len(words) - 1 else step
        shard = (mixed % np.uint64(self.shards)).astype(np.int64)
        self.words = words
        self.order = np.argsort(_one_key([shard, context, last]))
        self.shard = shard[self.order]

    def counts(self, answers: list[bytes], n: int) -> np.ndarray:
        """The training count at each place, as coded; 0 where the n-gram is unknown."""
        log10 = np.concatenate([np.frombuffer(_decompress(a)[0], "<f4") for a in answers] + [np.zeros(0, "<f4")]).astype(float)
        own = np.empty(len(self.keys))
        own[self.order] = np.where(log10 == ABSENT, 0.0, 10.0**log10 * n)
        return np.where(self.at >= 0, own[self.at], 0.0) if len(own) else np.zeros(len(self.at))


def _one_key(words: list[np.ndarray]) -> np.ndarray:
    """One number per place that sorts as the words do, the first first; what would pass 62 bits is replaced by its rank."""
    key, *rest = words
    for word in rest:
        span, size = int(key.max(initial=0)) + 1, int(word.max(initial=0)) + 1
        if span * size >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            span = int(key.max(initial=0)) + 1
        if span * size >= 1 << 62:
            word = np.unique(word, return_inverse=True)[1]
            size = int(word.max(initial=0)) + 1
        key = key * size + word
    return key


def _scramble(x: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64-bit numbers."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _answers(rows: list[tuple]) -> pa.Table:
    chunk, level, shard, data, seen = zip(*rows)
    return pa.table(
        {
            "chunk": pa.array(chunk, pa.int64()),
            "level": pa.array(level, pa.int32()),
            "shard": pa.array(shard, pa.int32()),
            "data": pa.array(data, pa.list_(pa.binary())),
            "seen": pa.array(seen, pa.int64()),
        }
    )


def _requests(rows: list[tuple]) -> pa.RecordBatch:
    return _answers([(*r, 0) for r in rows]).combine_chunks().to_batches()[0]


def answer_tokens(shards: int):
    """A shard of tokens: to each chunk the counts of its tokens, their numbers + 1 (0: not in training), and which occur often."""

    def of(requests: pa.Table) -> pa.Table:
        rows = [(r["chunk"], r["shard"], r["data"]) for r in requests.to_pylist()]
        places, at = defaultdict(), []
        places.default_factory = places.__len__
        for _, _, data in rows:
            own = _split(data[0])
            at.append(np.fromiter(map(places.__getitem__, own), np.int64, len(own)))
        count, every = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        for own, (_, _, data) in zip(at, rows):
            count[own] += unsqueeze(data[1])
            every[own] += unsqueeze(data[2])
        # frequent words get small numbers; 0 is the word that begins each text
        rank = np.empty(len(places), np.int64)
        rank[np.lexsort((np.arange(len(places)), -count))] = np.arange(len(places))
        number = np.where(count > 0, 2 + rank * shards + rows[0][1], 0)
        seen = [int((count > 0).sum()), *[0] * (len(rows) - 1)]
        return _answers([(c, 1, s, [squeeze(count[own]), squeeze(number[own]), squeeze(every[own] > SPREAD)], k) for own, (c, s, _), k in zip(at, rows, seen)])

    return of


def answer_grams(n: int):
    """A shard of pairs or triples: its trie, and to each chunk the log10 probabilities of its n-grams."""

    def of(requests: pa.Table) -> pa.Table:
        rows = [(r["chunk"], r["level"], r["shard"], r["data"]) for r in requests.to_pylist()]
        asked = []
        for *_, data in rows:
            *gaps, own = map(unsqueeze, data)
            asked.append([*words_of(gaps), own])
        *words, count = (np.concatenate(c) for c in zip(*asked))
        key = _one_key(words)
        order = np.argsort(key)
        key = key[order]
        new = np.ones(len(order), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        total = np.add.reduceat(count[order], first)
        words = [w[order[first]] for w in words]  # distinct n-grams of all chunks; the trained ones make the trie
        some = total > 0
        trie = Trie.mapped(Trie.of([w[some] for w in words], np.log10(total[some] / max(n, 1))).dump())
        values = np.empty(len(order), "<f4")
        values[order] = trie.log10(words, ABSENT)[np.cumsum(new) - 1]
        ends = np.cumsum([len(own[0]) for own in asked])[:-1]
        return _answers([(c, level, s, [_compress(own.tobytes())], 0) for (c, level, s, _), own in zip(rows, np.split(values, ends))])

    return of


def fit_and_score(docs: DataFrame, trains: Column, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Score every row of ``docs`` with a model of the rows where ``trains`` holds.

    Returns id_col, the columns named in ``keep``, n_tokens, n_known, train_tokens, base_score and score (both
    log10), one row per row of ``docs``, whose other columns take no part whatever their names. Null and empty
    texts are one end token; a very long text is taken whole, in a chunk of its own size. Repeated rows and ids
    count and are scored as often as they occur; nothing is ranked, so there are no ties. An empty table gives no
    rows. With no training row every token has probability one over nothing but the unknown: both scores are 0.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    text = F.col(text_col).cast("string").cast("binary")
    doc = F.struct(F.col(id_col).alias("id"), F.struct(F.lit(0).alias("_"), *keep).alias("kept"))
    texts = docs.select(text.alias("text"), F.coalesce(trains, F.lit(False)).alias("trains"), doc.alias("doc"))
    # numbered as they are written, so no task sees a chunk change
    chunks = scratch.write(chunks_of(texts).withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    total, n, n_texts = (x or 0 for x in chunks.agg(F.sum("n"), F.sum("n_train"), F.sum("texts")).first())
    shards = -(-total // SHARD) or 1

    def ask_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens = _split(row["tokens"])
                chunk = Chunk(row, token_shards(tokens, shards), shards)
                yield _requests([(row["chunk"], 1, s, data) for s, data in chunk.token_requests(tokens)])

    def without_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index("tokens")
            own = [squeeze(token_shards(_split(t.as_py()), shards)) for t in batch.column(place)]
            yield batch.set_column(place, "shards", pa.array(own, pa.binary()))

    def learned(row: dict) -> Chunk:
        chunk = Chunk(row, unsqueeze(row["shards"]), shards)
        chunk.learn([a["data"] for a in row["answers"]], n_texts)
        return chunk

    def ask_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).drop_columns("docs").to_pylist()[0]
                rows = [(row["chunk"], *r) for r in learned(row).gram_requests()]
                if rows:
                    yield _requests(rows)

    asked = chunks.select("chunk", "ids", "lengths", "trains", "tokens").mapInArrow(ask_tokens, ANSWER)
    tokens = scratch.write(asked.groupBy("shard").applyInArrow(answer_tokens(shards), ANSWER), "tokens")
    v = tokens.agg(F.sum("seen")).first()[0] or 0

    by_chunk = lambda answers, name: answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("level", "shard", "data"))).alias(name))
    moved = chunks.select("chunk", "ids", "lengths", "trains", "tokens", "docs")
    moved_type = T.StructType([T.StructField("shards", f.dataType) if f.name == "tokens" else f for f in moved.schema])
    # one plan up to the scores: both readers of this join find the same exchanges, and n-grams' answers are written once
    met = moved.mapInArrow(without_texts, moved_type).join(by_chunk(tokens, "answers"), "chunk")
    grams = met.mapInArrow(ask_grams, ANSWER).groupBy("level", "shard").applyInArrow(answer_grams(n), ANSWER)

    doc_type = chunks.schema["docs"].dataType.elementType
    schema = T.StructType([T.StructField("doc", doc_type)]).add("n_tokens", "long").add("n_known", "long").add("base_score", "double").add("score", "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                row = one.drop_columns("docs").to_pylist()[0]
                at = lambda level: [a["data"][0] for a in row["grams"] or () if a["level"] == level]
                got = learned(row).scores(at(2), at(3), n, v)
                yield pa.RecordBatch.from_arrays([one.column("docs").flatten(), *map(pa.array, got)], schema.names)

    # a chunk of which no token is in training asks for no n-grams
    scored = scratch.write(met.join(by_chunk(grams, "grams"), "chunk", "left").mapInArrow(score, schema), "scores")
    scratch.drop("chunks", "tokens")
    return scored.select(
        F.col("doc.id").alias(id_col),
        *[F.col("doc.kept")[c].alias(c) for c in keep],
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op4_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", id_remainder(F.col("doc_id"), 7) == 2)
    return fit_and_score(docs, ~F.col("held_out"), keep=("held_out",))
