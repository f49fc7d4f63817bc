import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from paysight.llm import collocations as C
from paysight.llm.common import Scratch

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_count, top, max_words=4, percent=80):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + m])) for m in range(1, max_words + 1) for i in range(len(words) - m + 1))
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    longer, out = Counter(), {}
    for (lang, q), b in candidates.items():
        for p in {q[i:j] for i in range(len(q)) for j in range(i + 2, len(q) + 1)} - {q}:
            longer[lang, p] = max(longer[lang, p], b)
    for (lang, p), a in candidates.items():
        if not 100 * longer[lang, p] >= percent * a:
            score, _, l, r = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items() for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)
    )


def rows_of(seed, n=120):
    """Few words, so that phrases repeat, overlap and tie."""
    rng = random.Random(seed)
    words = ["a", "A", "b", "c", "É", "é", "dd", "x1", "\x1c", "北京", "e'f"]
    gap = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "!", ";", "\x0b"]
    text = lambda: "".join(rng.choice(words[: rng.randint(2, 11)]) + rng.choice(gap) for _ in range(rng.randint(0, 60)))
    return [(text(), rng.choice(["en", "en", "fr", None, "und"])) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(t, g, 1, "w", "p") for t, g in rows], "text string, lang string, at int, word string, phrase string")


def got(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("seed,min_count,top", [(1, 5, 2000), (2, 2, 7), (3, 30, 2000)])
def test_equals_brute_force(spark, seed, min_count, top):
    rows = rows_of(seed)
    want = plain(rows, min_count, top)
    assert want and got(C.collocations(frame(spark, rows).repartition(4), min_count=min_count, top=top)) == want


def test_edges(spark, edge_docs, edge_rows):
    rows = [(r[1], r[2]) for r in edge_rows]
    assert got(C.collocations(edge_docs, min_count=2, top=50)) == plain(rows, 2, 50)
    assert C.collocations(frame(spark, []), min_count=2).count() == 0
    assert C.collocations(frame(spark, [("one two", "en")])).count() == 0


def test_chunks_flushes_and_a_full_filter_change_nothing(spark, monkeypatch):
    rows = rows_of(7, 60)
    want = plain(rows, 4, 2000)
    for name, value in (("CHUNK_BYTES", 9), ("TOKENS_AT_ONCE", 5), ("FLUSH_WORDS", 3), ("FLUSH_PHRASES", 4), ("CACHE_WORDS", 2)):
        monkeypatch.setattr(C, name, value)
    monkeypatch.setattr(C.BitFilter, "has", lambda self, keys: np.ones(len(keys), bool))  # everything passes
    assert got(C.collocations(frame(spark, rows), min_count=4)) == want


def test_equal_keys_of_different_phrases_are_told_apart(spark, monkeypatch):
    rows = rows_of(8, 60)
    want = plain(rows, 4, 2000)
    monkeypatch.setattr(C, "mix", lambda key, word: (key + word) % np.uint64(5))
    assert got(C.collocations(frame(spark, rows), min_count=4)) == want


def test_colliding_word_numbers_are_numbered_anew(spark, monkeypatch):
    real = C.xxhash.xxh64_intdigest

    class Poor:
        @staticmethod
        def xxh64_intdigest(x, seed):
            return real(x, seed) % 3 if seed == 42 else real(x, seed)

    rows = rows_of(9, 40)
    monkeypatch.setattr(C, "xxhash", Poor)
    assert got(C.collocations(frame(spark, rows), min_count=4)) == plain(rows, 4, 2000)


def test_ranking_in_parts_gives_the_same_ranks(spark):
    rows = [("en", [k, k + 1], 30 + k % 3, 40, 50, k % 5, f"p{k:04d}") for k in range(900)] + [("fr", [1, 2], 30, 40, 50, 9, "q")]
    df = spark.createDataFrame(rows, "lang string, words array<long>, a long, l long, r long, score long, phrase string")
    scratch = Scratch(spark, "t")
    whole = got(C.ranked(df, 20, scratch, rows=10**6))
    assert got(C.ranked(df, 20, scratch, rows=50)) == whole and len(whole) == 21
    assert got(C.ranked(C._above_cut(df, 20), 20, scratch)) == whole


def test_arithmetic_past_64_bits(spark):
    big = 9 * 10**18
    df = spark.createDataFrame([("en", [1], big), ("en", [2], big - 7), ("en", [1, 2], big - 8)], "lang string, words array<long>, n long")
    r = C.scored_candidates(df).first()
    assert r.score == 2_000_000 * (big - 8) // (2 * big - 7)
    assert C.not_covered(C.scored_candidates(df)).count() == 1


def test_bit_filter_misses_nothing(spark):
    keys = np.random.default_rng(1).integers(-(2**63), 2**63, 3000)
    df = spark.createDataFrame([(int(k),) for k in keys[:1500]], "key long")
    kept = C.BitFilter.of(df.repartition(3), 1500)
    assert kept.has(keys[:1500].view(np.uint64)).all() and kept.has(keys[1500:].view(np.uint64)).mean() < 0.1
