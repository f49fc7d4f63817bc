"""Language identification by segmentation-marginalised unigrams.

Every language has one probability per piece of a fixed public vocabulary. The probability of a word
is the sum, over all ways to cut it into pieces, of the product of its pieces' probabilities; a
forward pass over the word's positions gives it without listing the cuts. What the pass carries (the sums at
the last few positions, as far as a piece reaches) is rescaled on the way, so words of any length have finite
log probabilities. The probability of a text is the product over its words. Training is expectation maximisation over all training rows: each
task counts its words, runs forward and backward passes over the distinct ones, and hands on expected
piece counts, which Spark sums by (language, piece).
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import id_remainder, table

START = "▁"  # begins every word, as in the vocabulary
CACHE_WORDS = 1 << 20  # distinct words that a task counts, or a worker keeps the scores of, at a time
DENSE = 64  # letters with a full row of trie steps; the others' steps are searched for
CELLS_AT_ONCE = 1 << 19  # letters of words laid side by side
RESCALE = 8  # positions between two rescalings
EDGES_KEPT = 128  # positions of words up to this long keep their pieces for the backward pass; longer ones find them again
TEXTS_AT_ONCE = 256
COUNT_UNIT = 1024  # expected counts travel as whole numbers of this fraction, so their sums are exact
SMOOTHING = 0.5
ROUNDS = 2
UNDETERMINED = "und"

LETTERS = regex.compile(r"\p{L}+")


def runs_of(text: str | None) -> list[str]:
    """What stands between white space. Words never cross it, so all work is done once per distinct run."""
    return text.lower().split() if text else []


def words_of(run: str) -> list[str]:
    """The letter words of a run; most runs are one."""
    return [run] if run.isalpha() else LETTERS.findall(run)


@lru_cache(maxsize=2)
def read_pieces(path: str) -> tuple[str, ...]:
    """The letter pieces of a sentencepiece vocabulary, lower-cased, in its order; then all their single letters."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    every = [model.id_to_piece(i).lower() for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    pieces = [p for p in every if p.lstrip(START).isalpha() and p.rfind(START) <= 0]
    return tuple(dict.fromkeys([*pieces, *sorted({c for p in pieces for c in p}), START]))


class Segmenter:
    """Where pieces stand in words: a trie over the pieces, walked for many words together."""

    def __init__(self, pieces: tuple[str, ...]):
        self.size = len(pieces) + 1  # the last number is any other single letter
        self.longest = max(map(len, pieces), default=1)
        uses = Counter(c for p in pieces for c in p)
        self.codes = {c: k + 1 for k, c in enumerate(sorted(uses, key=lambda c: (-uses[c], c)))}
        self.width = len(self.codes) + 1
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[[ord(c) for c in self.codes]] = list(self.codes.values())
        step: dict[int, int] = {}
        number = [-1]
        for k, piece in enumerate(pieces):
            node = 0
            for c in piece:
                node = step.setdefault(node * self.width + self.codes[c], len(number))
                if node == len(number):
                    number.append(-1)
            number[node] = k
        self.keys = np.array(sorted(step), np.int64)
        self.nodes = np.array([step[k] for k in self.keys.tolist()], np.int32)
        self.number = np.array(number, np.int32)
        self.dense = np.full((len(number), DENSE), -1, np.int32)
        common = self.keys % self.width < DENSE
        self.dense[self.keys[common] // self.width, self.keys[common] % self.width] = self.nodes[common]

    def step(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The node below each node by a letter, or -1."""
        out = self.dense[node, np.minimum(code, DENSE - 1)]
        other = np.flatnonzero(code >= DENSE)
        if len(other):
            key = node[other].astype(np.int64) * self.width + code[other]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out[other] = np.where(self.keys[place] == key, self.nodes[place], -1)
        return out


class Layout:
    """Words side by side: the code of every word's letter at every position."""

    def __init__(self, seg: Segmenter, words: list[str]):
        self.seg = seg
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.longest = int(self.lengths.max(initial=0))
        self.code = np.zeros((self.longest + seg.longest, len(words)), np.int32)
        flat = seg.letter[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        row = np.repeat(np.arange(len(words)), self.lengths)
        self.code[np.arange(len(flat)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths), row] = flat
        self.kept: dict[int, list] = {}

    def edges(self, start: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(letters, words that have a piece of so many letters at the position, the pieces)."""
        if start in self.kept:
            return self.kept[start]
        seg, found = self.seg, []
        at = np.flatnonzero(self.lengths > start)
        node = np.zeros(len(at), np.int32)
        for length in range(1, seg.longest + 1):
            below = seg.step(node, self.code[start + length - 1, at])
            on = below >= 0
            if length == 1 and not on.all():  # a letter outside the vocabulary
                other = at[~on]
                found.append((1, other, np.full(len(other), seg.size - 1)))
            at, node = at[on], below[on]
            if not len(at):
                break
            piece = seg.number[node]
            has = piece >= 0
            if has.any():
                found.append((length, at[has], piece[has]))
        if self.longest <= EDGES_KEPT:
            self.kept[start] = found
        return found


@lru_cache(maxsize=2)
def segmenter(path: str) -> Segmenter:
    return Segmenter(read_pieces(path))


def batches_of(seg: Segmenter, words: list[str]) -> Iterator[np.ndarray]:
    """The words' numbers, short words first, as many at a time as fit CELLS_AT_ONCE (a longer word by itself)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    order, first = np.argsort(lengths, kind="stable"), 0
    while first < len(order):
        cells = (lengths[order[first:]] + seg.longest) * np.arange(1, len(order) - first + 1)
        stop = first + max(1, int(np.searchsorted(cells, CELLS_AT_ONCE, side="right")))
        yield order[first:stop]
        first = stop


def _rescaled(ring: np.ndarray, now: np.ndarray, live: np.ndarray, scale: np.ndarray) -> None:
    """Divide what the ring holds for the live words by ``now``, and add its logarithm to their scale."""
    by = np.where(live[:, None] & (now > 0), now, 1.0)
    ring /= by
    scale += np.log(by)


def forward(lay: Layout, probs: np.ndarray, keep: bool = False):
    """Log probability of each word in each language, summed over all its segmentations; with ``keep`` also, for
    every position, the sum of its prefixes and the logarithm of what that was divided by."""
    n, size = len(lay.lengths), lay.seg.longest + 1
    ring, scale = np.zeros((size, n, probs.shape[1])), np.zeros((n, probs.shape[1]))
    ring[0] = 1.0
    out, kept = np.zeros_like(scale), []
    for start in range(lay.longest + 1):
        now = ring[start % size]
        if start % RESCALE == 0:
            _rescaled(ring, now.copy(), lay.lengths >= start, scale)
        ends = lay.lengths == start
        if ends.any():
            out[ends] = scale[ends] + np.log(now[ends])
        if keep:
            kept.append((now.copy(), scale.copy()))
        for length, at, piece in lay.edges(start) if start < lay.longest else ():
            ring[(start + length) % size][at] += now[at] * probs[piece]
        now[:] = 0.0
    return (out, kept) if keep else out


def word_scores(seg: Segmenter, words: list[str], probs: np.ndarray) -> np.ndarray:
    """Natural log probability of each word in each language."""
    out = np.zeros((len(words), probs.shape[1]))
    for some in batches_of(seg, words):
        out[some] = forward(Layout(seg, [START + words[k] for k in some]), probs)
    return out


def expected_counts(seg: Segmenter, words: list[str], counts: list[int], probs: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in ``counts`` copies of the words, by forward and backward passes (one language)."""
    out, probs, size = np.zeros(seg.size), probs[:, None], seg.longest + 1
    copies = np.array(counts, float)
    for some in batches_of(seg, words):
        lay = Layout(seg, [START + words[k] for k in some])
        total, kept = forward(lay, probs, keep=True)
        ring, scale = np.zeros((size, len(some), 1)), np.zeros((len(some), 1))
        for start in range(lay.longest, -1, -1):
            before, divided = kept[start]
            now = ring[start % size]
            now[:] = 0.0
            now[lay.lengths == start] = 1.0
            # what a path through here has, of all paths of the word
            share = (before * np.exp(divided + scale - total))[:, 0] * copies[some] if start < lay.longest else None
            for length, at, piece in lay.edges(start) if start < lay.longest else ():
                rest = probs[piece] * ring[(start + length) % size][at]
                now[at] += rest
                out += np.bincount(piece, share[at] * rest[:, 0], seg.size)
            if start % RESCALE == 0:
                _rescaled(ring, now.copy(), lay.lengths >= start, scale)
    return out


@dataclass
class LanguageModel:
    """Piece probabilities [piece, language] and prior of the learned languages, in their sorted order."""

    path: str
    languages: list[str]
    probs: np.ndarray
    prior: np.ndarray


class Scorer:
    """A worker's scores of distinct runs: a cache that is emptied when it is full.

    Row 0 of the scores is no run; the last column counts a run's words.
    """

    def __init__(self, model: LanguageModel):
        self.model, self.seg = model, segmenter(model.path)
        self.scores = np.zeros((1 << 12, len(model.languages) + 1))
        self.place: dict[str, int] = {}

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = []
        for a in range(0, len(texts), TEXTS_AT_ONCE):
            docs = [runs_of(t) for t in texts[a : a + TEXTS_AT_ONCE]]
            self._learn(docs)
            out += map(self._one, docs)
        return out

    def _learn(self, docs: list[list[str]]) -> None:
        new = set().union(*docs).difference(self.place)
        if len(self.place) + len(new) > CACHE_WORDS:
            self.place.clear()
            new = set().union(*docs)
        runs, first = list(new), len(self.place) + 1
        while first + len(runs) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        self.place.update(zip(runs, range(first, first + len(runs))))
        words = [words_of(r) for r in runs]
        distinct = list({w for own in words for w in own})
        number = dict(zip(distinct, range(len(distinct))))
        scored = word_scores(self.seg, distinct, self.model.probs)
        at = np.fromiter((number[w] for own in words for w in own), np.int64)
        run = np.repeat(np.arange(first, first + len(runs)), [len(own) for own in words])
        self.scores[first : first + len(runs)] = 0.0
        for k in range(scored.shape[1]):
            self.scores[first : first + len(runs), k] = np.bincount(run - first, scored[at, k], len(runs))
        self.scores[first : first + len(runs), -1] = np.bincount(run - first, minlength=len(runs))

    def _one(self, runs: list[str]) -> tuple[str, float]:
        total = self.scores[np.fromiter(map(self.place.__getitem__, runs), np.int64, len(runs))].sum(axis=0)
        if not total[-1] or not self.model.languages:
            return UNDETERMINED, 0.0
        total = total[:-1] + self.model.prior
        weight = np.exp(total - total.max())
        best = int(total.argmax())
        return self.model.languages[best], float(weight[best] / weight.sum())


_WORKER: dict[str, Scorer] = {}


def _count_pieces(path: str, start: np.ndarray, known: dict[str, np.ndarray]):
    """A task's expected piece counts by language, and its rows by language under piece -1."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = segmenter(path)
        runs: dict[str, Counter[str]] = {}
        sums: dict[str, np.ndarray] = {}
        rows: Counter[str] = Counter()

        def flush() -> None:
            for lang, seen in runs.items():
                words: Counter[str] = Counter()
                for run, n in seen.items():
                    for word in words_of(run):
                        words[word] += n
                sums[lang] = sums.get(lang, 0) + expected_counts(seg, list(words), list(words.values()), known.get(lang, start))
            runs.clear()

        for batch in batches:
            for lang, text in zip(batch[0].to_pylist(), batch[1].to_pylist()):
                runs.setdefault(lang, Counter()).update(runs_of(text))
                rows[lang] += 1
                if sum(map(len, runs.values())) > CACHE_WORDS:
                    flush()
        flush()
        for lang in rows:
            counts = np.rint(sums.get(lang, np.zeros(seg.size)) * COUNT_UNIT).astype(np.int64)
            used = np.flatnonzero(counts)
            piece, n = np.append(used, -1), np.append(counts[used], rows[lang])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(piece), pa.string()), pa.array(piece), pa.array(n)], ["lang", "piece", "n"])

    return task


def fit_languages(rows: DataFrame, lang_col: str, text_col: str, vocabulary_path: str, rounds: int = ROUNDS) -> LanguageModel:
    """Piece probabilities from all rows with a language. What reaches the driver is bounded by languages times pieces."""
    seg = segmenter(vocabulary_path)
    start = 1.0 / (np.arange(seg.size) + 10.0)  # the vocabulary's order is by frequency
    start /= start.sum()
    labelled = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).filter("lang IS NOT NULL")
    known: dict[str, np.ndarray] = {}
    prior: dict[str, int] = {}
    for _ in range(rounds):
        counted = labelled.mapInArrow(_count_pieces(vocabulary_path, start, known), "lang string, piece long, n long")
        got = counted.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        known = {}
        for lang, own in got[got.piece >= 0].groupby("lang"):
            counts = np.full(seg.size, SMOOTHING)
            counts[own.piece.to_numpy()] += own.n.to_numpy() / COUNT_UNIT
            known[lang] = counts / counts.sum()
        prior = dict(got[got.piece == -1][["lang", "n"]].itertuples(index=False))
    languages = sorted(prior)
    probs = np.stack([known.get(lang, start) for lang in languages], axis=1) if languages else np.zeros((seg.size, 0))
    weight = np.array([prior[lang] for lang in languages], float)
    return LanguageModel(vocabulary_path, languages, probs, np.log(weight / weight.sum()) if languages else weight)


def identify(text: Column, model: LanguageModel, spark) -> Column:
    """Struct (lang_pred, score). Null texts and texts without a letter, and all texts if no language was learned, are ``und`` with score 0."""
    run = uuid.uuid4().hex
    shared = spark.sparkContext.broadcast(model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @arrow_udf("struct<lang_pred:string,score:double>")
    def predict(batch: pa.Array) -> pa.Array:
        if run not in _WORKER:
            _WORKER.clear()
            _WORKER[run] = Scorer(shared.value)
        return pa.array([{"lang_pred": a, "score": b} for a, b in _WORKER[run].predict(batch.to_pylist())], kind)

    return predict(text.cast("string"))


def vocabulary_file(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", id_remainder(F.col("doc_id"), 4) == 2)
    model = fit_languages(docs.filter("NOT held_out"), "lang", "text", vocabulary_file())
    return docs.select("doc_id", "held_out", identify(F.col("text"), model, spark).alias("p")).select("doc_id", "held_out", "p.*")
