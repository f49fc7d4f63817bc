"""Token counts of a public tokenizer, without any shuffle of its pre-tokens.

The tokenizer drops white space and its split pattern never crosses it, so the count of a text is
the sum over its white-space-free runs. Two tiers give a run's count on the map side:

* a compact table of the most frequent runs, measured on a bounded number of rows (they only decide
  what is looked up fast, never a result) and broadcast: one byte string of the runs, and arrays of
  their ends and counts;
* a cache in each worker for all others, filled by the library itself in batches and emptied when
  it holds ``CACHE_RUNS``.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import table

FREQUENT_RUNS = 1 << 16  # bound of the broadcast table, in runs
FREQUENT_RUN_LETTERS = 16  # longer runs are left to the caches
SAMPLE_ROWS = 128  # rows of an input partition whose runs are counted for that table
CACHE_RUNS = 1 << 18
LIMIT = 2048

# str.split() also cuts at these four, which the tokenizer's pattern does not take for white space.
NOT_SPACE = "\x1c\x1d\x1e\x1f"


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def encoded_lengths(path: str, runs: list[str]) -> list[int]:
    return [len(e.ids) for e in _library(path).encode_batch_fast(runs, add_special_tokens=False)]


def pretoken_runs(text: str) -> list[str]:
    """The runs of a text between the tokenizer's white space."""
    if any(c in text for c in NOT_SPACE):
        return regex.findall(r"\P{White_Space}+", text)
    return text.split()


class Lengths:
    """Frequent tier and bounded cache of one worker."""

    def __init__(self, path: str, packed: tuple[bytes, np.ndarray, np.ndarray]):
        runs, ends, counts = packed
        starts = [0, *ends[:-1].tolist()]
        self.path = path
        self.frequent = {runs[a:b].decode(): n for a, b, n in zip(starts, ends.tolist(), counts.tolist())}
        self.known = dict(self.frequent)

    def of(self, texts: list[str | None]) -> list[int]:
        """Token counts, by the library once for every run that neither tier holds."""
        out = []
        for text in texts:
            runs = pretoken_runs(text) if text else []
            get = self.known.__getitem__
            try:
                out.append(sum(map(get, runs)))
                continue
            except KeyError:
                pass
            new = list({r for r in runs if r not in self.known})
            if len(self.known) + len(new) > CACHE_RUNS + len(self.frequent):
                self.known = dict(self.frequent)
                new = list({r for r in runs if r not in self.known})
            self.known.update(zip(new, encoded_lengths(self.path, new)))
            out.append(sum(map(self.known.__getitem__, runs)))
        return out


_WORKER: dict[str, Lengths] = {}


def frequent_runs(docs: DataFrame, text_col: str, path: str, sample_rows: int, size: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The packed table, at most ``size`` runs, from the first rows of as many input partitions as give four times that many."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        left = sample_rows
        for batch in batches:
            for text in batch[0][:left].to_pylist():
                seen.update(r for r in pretoken_runs(text or "") if len(r) <= FREQUENT_RUN_LETTERS)
            left -= len(batch)
            if left <= 0:
                break
        top = seen.most_common(size)
        yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["run", "n"])

    # a plain collected limit runs partition after partition until it is met, so this stays bounded
    counted = docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(count, "run string, n long").limit(4 * size)
    total: Counter[str] = Counter()
    for r in counted.collect():
        total[r["run"]] += r["n"]
    runs = sorted(r for r, _ in total.most_common(size))
    data = [r.encode() for r in runs]
    lengths = encoded_lengths(path, runs) if runs else []
    return b"".join(data), np.cumsum([len(d) for d in data], dtype=np.int64), np.array(lengths, np.uint16)


def count_tokens(
    docs: DataFrame,
    text_col: str = "text",
    out_col: str = "n_tokens",
    tokenizer_path: str | None = None,
    frequent: int = FREQUENT_RUNS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``docs`` with the token count of each whole text, as the tokenizer's library gives it by default.

    No begin or end tokens are added; special strings in a text count as the library takes them.
    Null and empty texts count 0. Repeated rows and other columns stay as they are; a column named
    ``out_col`` is replaced. The tokenizer must drop white space and never merge across it.
    """
    path = tokenizer_path or tokenizer_file()
    run = uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast(frequent_runs(docs, text_col, path, sample_rows, frequent))

    @arrow_udf("long")
    def lengths(text: pa.Array) -> pa.Array:
        if run not in _WORKER:
            _WORKER.clear()
            _WORKER[run] = Lengths(path, shared.value)
        return pa.array(_WORKER[run].of(text.to_pylist()), pa.int64())

    return docs.withColumn(out_col, lengths(F.col(text_col).cast("string")))


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs).select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > LIMIT).alias("over_limit"),
    )
