import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paysight.llm import lm as L
from paysight.llm.elias_fano import EliasFano, Level, Trie, quantise


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), ""]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 10**6), max_size=200), st.lists(st.integers(-3, 10**6 + 3), max_size=50))
def test_sequence_round_trip_and_search(values, asked):
    values = np.sort(np.array(values, np.int64))
    seq = EliasFano.of(values)
    assert np.array_equal(seq.get(np.arange(len(values))), values)
    asked = np.array([*asked, *values[:20]], np.int64)
    got = seq.find(asked)
    assert all((values[g] == a and (g == 0 or values[g - 1] < a)) if g >= 0 else a not in values for a, g in zip(asked.tolist(), got.tolist()))


def test_search_passes_long_runs_of_entries():
    """Buckets of 63 to 65 and of hundreds of entries, and empty ones, at every offset in a word."""
    for n in (63, 64, 65, 127, 300):
        for before in range(66):
            values = np.array([*range(0, 7 * before, 7), *[7 * before + 3] * n, 7 * before + 900], np.int64)
            seq = EliasFano.of(values)
            asked = np.arange(-1, 7 * before + 902)
            place = np.searchsorted(values, asked)
            want = np.where((place < len(values)) & (values[np.minimum(place, len(values) - 1)] == asked), place, -1)
            assert np.array_equal(seq.find(asked), want)


def test_a_level_search_selects_about_three_bits_a_query(monkeypatch):
    """The end of a range is the start of the next, and a bucket's end is seen from its start (six before)."""
    from paysight.llm import elias_fano as E

    level = Level.of(np.arange(5000), np.arange(5000) * 7919 % 1000, 5000)
    done = []
    plain = E._select_in_word
    monkeypatch.setattr(E, "_select_in_word", lambda word, k: done.append(len(k)) or plain(word, k))
    assert np.array_equal(level.find(np.arange(5000), np.arange(5000) * 7919 % 1000), np.arange(5000))
    assert sum(done) < 3.5 * 5000


@given(st.lists(st.tuples(st.integers(0, 2**61), st.integers(0, 2**61), st.integers(0, 3))))
def test_one_key_sorts_as_its_words_do(rows):
    words = [np.array([r[k] for r in rows], np.int64) for k in range(3)]
    key = L._one_key(words)
    assert [rows[k] for k in np.argsort(key)] == sorted(rows) and len(set(key.tolist())) == len(set(rows))


@settings(max_examples=60, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 20), st.integers(0, 300)), max_size=150))
def test_level_finds_every_entry_in_its_range_only(entries):
    rows = sorted(entries)
    context, value = (np.array([r[k] for r in rows], np.int64) for k in (0, 1))
    level = Level.of(context, value, 22)
    at = {r: k for k, r in enumerate(rows)}
    asked = [(c, v) for c in range(22) for v in [*range(0, 301, 37), *(b for a, b in rows if a == c)]]
    got = level.find(np.array([a for a, _ in asked]), np.array([b for _, b in asked]))
    assert [at.get(x, -1) for x in asked] == got.tolist()


def test_quantised_values_are_close():
    values = np.random.default_rng(0).normal(-3, 1, 20_000)
    codes, table = quantise(values)
    assert len(table) <= 256 and np.abs(table[codes] - values).mean() < 0.02


@settings(max_examples=60, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 9), st.integers(0, 2**40), st.integers(0, 30)), max_size=80), st.integers(0, 2**40))
def test_trie_finds_its_ngrams_and_no_others(grams, other):
    rows = sorted(grams)
    words = [np.array([r[k] for r in rows], np.int64) for k in range(3)]
    trie = Trie.mapped(Trie.of(words, -np.arange(len(rows)) / 7).dump())
    asked = sorted({*rows, *((a, other, c) for a, _, c in rows), (3, other, 4)})
    got = trie.log10([np.array([r[k] for r in asked], np.int64) for k in range(3)], 1.0)
    place = {r: -k / 7 for k, r in enumerate(rows)}
    assert np.allclose(got, [place.get(r, 1.0) for r in asked])


@given(st.lists(st.integers(0, 2**40)))
def test_squeezed_numbers_round_trip(values):
    assert L.unsqueeze(L.squeeze(np.array(values, np.int64))).tolist() == values


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 2**40))))
def test_gaps_of_sorted_ngrams_round_trip_and_are_no_larger(rows):
    words = [np.array([r[k] for r in sorted(rows)], np.int64) for k in range(3)]
    gaps = L.gaps_of(words)
    assert all(np.array_equal(a, b) for a, b in zip(L.words_of(gaps), words))
    assert all((g >= 0).all() and (g <= w).all() for g, w in zip(gaps, words))


def test_chunks_move_once_and_only_scores_stay_on_disk(spark, make_docs, monkeypatch):
    """Both readers of the chunks and their tokens' answers share the exchanges, and no step's table outlives the call."""
    for name in ("CHUNK", "SHARD"):
        monkeypatch.setattr(L, name, 2000)
    monkeypatch.setattr(L, "SPREAD", 50)
    roots, plans, write = [], [], L.Scratch.write

    def watched(self, df, name):
        roots.append(self.root)
        if name == "scores":
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
        return write(self, df, name)

    monkeypatch.setattr(L.Scratch, "write", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(k, " ".join(f"w{(k * j) % 97}" for j in range(30))) for k in range(600)]
        got = L.fit_and_score(make_docs(rows), F.col("doc_id") % 7 != 2)
        assert got.count() == 600
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans and plans[0].count("ReusedExchange") == 2
    root = spark._jvm.org.apache.hadoop.fs.Path(roots[0])
    files = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    assert [f.getPath().getName() for f in files] == ["scores"]


def plain_model(train):
    """The base and interpolated probabilities by dictionaries over every token, pair and triple of the training texts."""
    laid = [["<begin>", *tokens(x)] for x in train]
    counts = Counter(t for x in laid for t in x[1:])
    n, v = sum(counts.values()), len(counts)
    two = Counter(p for x in laid for p in zip(x, x[1:]))
    three = Counter(p for x in laid for p in zip(x, x[1:], x[2:]))
    context = Counter(w for x in laid for w in x[:-1])
    uni = lambda w: (counts[w] + 1) / (n + v + 1)

    def mixed(own, total, lower):
        if not total:
            return lower
        part = 0.75 * total**-0.25
        return (1 - part) * own / total + part * lower

    def probability(a, u, w):
        lower = mixed(two[u, w], context[u], uni(w))
        return lower if a is None else mixed(three[a, u, w], two[a, u], lower)

    return counts, n, v, uni, probability


def plain_scores(train, texts):
    counts, n, _, uni, probability = plain_model(train)
    out = []
    for x in texts:
        base = score = 0.0
        a, u = None, "<begin>"
        for w in tokens(x):
            base += math.log10(uni(w))
            score += math.log10(probability(a, u, w))
            a, u = u, w
        out.append((len(tokens(x)), sum(counts[t] > 0 for t in tokens(x)), n, base, score))
    return out


# one chunk and shard; many of both; many, with most contexts spread over them
@pytest.mark.parametrize("sf,chunk,shard,spread", [("0.001", L.CHUNK, L.SHARD, L.SPREAD), ("0.001", 1500, 3000, 50), ("0.001", 700, 9000, 0), ("0.01", 1 << 15, 1 << 16, 1 << 9)])
def test_query_equals_a_model_over_dictionaries(spark, monkeypatch, sf, chunk, shard, spread):
    for name, value in (("CHUNK", chunk), ("SHARD", shard), ("SPREAD", spread)):
        monkeypatch.setattr(L, name, value)
    sf_dir = f"/root/testdata/sf{sf}"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k, _ in docs}
    expected = plain_scores([t for k, t in docs if not held[k]], [t for _, t in docs])
    got = {r.doc_id: r for r in L.op4_lm_scoring(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    off = []
    for (k, _), (n_tokens, n_known, n, base, score) in zip(docs, expected):
        r = got[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[k], n_tokens, n_known, n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9)
        off.append(abs(r.score - score) / n_tokens)
    # the tries' probabilities are coded in eight bits
    assert np.mean(off) < 0.002 and max(off) < 0.02


def test_probabilities_of_all_words_sum_to_one():
    train = ["a b c a b d", "a b c", "c c a", "b d a b"] * 3
    counts, n, v, _, probability = plain_model(train)
    inner = [w for w in counts if w]  # nothing follows the end
    for a in [None, "<begin>", *inner]:
        for u in [*inner, "never"]:
            total = sum(probability(a, u, w) for w in counts) + probability(a, u, "never")
            assert abs(total - 1) < 1e-9


def test_a_larger_corpus_keeps_its_rare_ngrams(spark, make_docs):
    """The same rare passage scores alike however many other texts there are: nothing is cut by size."""
    rare = "quartz violin meadow lantern orbit"
    filler = [f"common words repeat here again {k % 3}" for k in range(4000)]
    found = []
    for some in (filler[:40], filler):
        rows = [(k, t) for k, t in enumerate([rare, "meadow quartz orbit violin lantern", *some])]
        got = {r.doc_id: r.score for r in L.fit_and_score(make_docs(rows), F.col("doc_id") != 1).collect()}
        found.append(got[0] - got[1])
    assert min(found) > 3


def test_edges_and_empty_training(spark, edge_docs, make_docs, edge_rows):
    got = L.fit_and_score(edge_docs, F.col("doc_id") > 3).collect()
    train = [r[1] for r in edge_rows if r[0] is not None and r[0] > 3]
    expected = plain_scores(train, [r[1] for r in edge_rows])
    rows = sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, f"{r.base_score:.9g}", r.score) for r in got)
    wanted = sorted((r[0] or -1, *e[:3], f"{e[3]:.9g}", e[4]) for r, e in zip(edge_rows, expected))
    assert [r[:-1] for r in rows] == [w[:-1] for w in wanted]
    assert all(abs(r[-1] - w[-1]) <= 0.02 * r[1] for r, w in zip(rows, wanted))
    untrained = L.fit_and_score(edge_docs, F.lit(False)).collect()
    assert len(untrained) == len(edge_rows) and all(r.base_score == 0 and r.score == 0 and r.n_known == 0 for r in untrained)
    assert L.fit_and_score(make_docs([]), F.lit(True)).count() == 0
