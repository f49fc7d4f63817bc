import math
import zlib

import numpy as np
import pytest

from paysight.llm import langid as L

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def seg():
    return L.segmenter(L.vocabulary_file())


def every_cut(word, known):
    """All ways to cut a word into known pieces, single letters always allowed."""
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        if word[:k] in known or k == 1:
            for rest in every_cut(word[k:], known):
                yield [word[:k], *rest]


def test_forward_and_backward_equal_listing_all_segmentations(seg):
    known = {p: k for k, p in enumerate(L.read_pieces(L.vocabulary_file()))}
    rng = np.random.default_rng(1)
    probs = rng.random((seg.size, 2))
    probs /= probs.sum(axis=0)
    number = lambda p: known.get(p, seg.size - 1)
    words = ["a", "the", "straße", "ñandú", "xqฟz", "entre"]
    scores = L.word_scores(seg, words, probs)
    counts = L.expected_counts(seg, words, [1, 2, 3, 4, 5, 6], probs[:, 0])
    expected = np.zeros(seg.size)
    for word, got, n in zip(words, scores, range(1, 7)):
        cuts = [[number(p) for p in cut] for cut in every_cut(L.START + word, known)]
        weights = np.array([np.prod(probs[cut], axis=0) for cut in cuts])
        assert np.allclose(got, np.log(weights.sum(axis=0)))
        for cut, share in zip(cuts, weights[:, 0] / weights[:, 0].sum()):
            np.add.at(expected, cut, share * n)
    assert np.allclose(counts, expected)


def log_sum(word, known, logs):
    """Log of the sum over all segmentations, position by position in plain Python."""
    word, unknown = L.START + word, len(known)
    best = [0.0] + [-math.inf] * len(word)
    for end in range(1, len(word) + 1):
        terms = [best[k] + logs[known[word[k:end]]] for k in range(max(0, end - 20), end) if word[k:end] in known]
        if word[end - 1] not in known:
            terms.append(best[end - 1] + logs[unknown])
        top = max(terms)
        best[end] = top + math.log(sum(math.exp(t - top) for t in terms))
    return best[-1]


@pytest.mark.parametrize("n", [1e3, 1e11, 1e15])
def test_long_words_are_scored_whole_at_any_corpus_size(seg, n):
    known = {p: k for k, p in enumerate(L.read_pieces(L.vocabulary_file()))}
    assert seg.longest > 10 and max(map(len, known)) == seg.longest
    rng = np.random.default_rng(3)
    counts = np.where(rng.random(seg.size) < 0.5, 0.0, rng.random(seg.size) * n / seg.size) + L.SMOOTHING
    probs = (counts / counts.sum())[:, None]
    words = ["q" * 40, "ฟ" * 64, "information" * 91, "a" * 500 + "qx" * 300, "straßenbahn", "ñ" * 1000, "ab" * 3000]
    got = L.word_scores(seg, words, probs)[:, 0]
    assert np.isfinite(got).all()
    assert np.allclose(got, [log_sum(w, known, np.log(probs[:, 0])) for w in words], rtol=1e-9)
    uses = L.expected_counts(seg, words, [640] * len(words), probs[:, 0])
    letters = np.array([len(p) for p in L.read_pieces(L.vocabulary_file())] + [1])
    # the expected pieces cover every letter of every copy
    assert np.isfinite(uses).all() and np.isclose(uses @ letters, 640 * sum(len(w) + 1 for w in words), rtol=1e-6)


def test_batches_change_nothing(seg, monkeypatch):
    rng = np.random.default_rng(4)
    probs = rng.random((seg.size, 2))
    words = ["".join(rng.choice(list("aeiouxyzß北")) for _ in range(k)) for k in (1, 200, 3, 40, 7, 500, 2)]
    a, c = L.word_scores(seg, words, probs), L.expected_counts(seg, words, list(range(1, 8)), probs[:, 1])
    monkeypatch.setattr(L, "CELLS_AT_ONCE", 64)
    monkeypatch.setattr(L, "EDGES_KEPT", 5)
    assert np.allclose(L.word_scores(seg, words, probs), a) and np.allclose(L.expected_counts(seg, words, list(range(1, 8)), probs[:, 1]), c)


def test_query_columns_folds_and_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = L.op1_language_id(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(truth) and len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert sum(held) / len(held) >= 0.95


def test_edges(spark, make_docs, edge_docs):
    train = make_docs([(k, t, lang) for k, (t, lang) in enumerate([("the cat and the dog in the house", "en"), ("der hund und die katze in dem haus", "de")] * 5)] + [(99, "no language", None)])
    model = L.fit_languages(train, "lang", "text", L.vocabulary_file())
    assert model.languages == ["de", "en"]
    from pyspark.sql import functions as F

    got = edge_docs.select("text", L.identify(F.col("text"), model, spark).alias("p")).collect()
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.p.lang_pred == "und") == (not letters) and 0 <= r.p.score <= 1
    none = L.fit_languages(make_docs([]), "lang", "text", L.vocabulary_file())
    assert {r.p.lang_pred for r in edge_docs.select(L.identify(F.col("text"), none, spark).alias("p")).collect()} == {"und"}


def test_cache_size_changes_nothing(monkeypatch, seg):
    rng = np.random.default_rng(2)
    probs = rng.random((seg.size, 3))
    model = L.LanguageModel(L.vocabulary_file(), ["a", "b", "c"], probs / probs.sum(axis=0), np.zeros(3))
    texts = ["one two three", "three four five six", None, "", "one one one"] * 3
    plain = L.Scorer(model).predict(texts)
    monkeypatch.setattr(L, "CACHE_WORDS", 2)
    monkeypatch.setattr(L, "TEXTS_AT_ONCE", 2)
    assert L.Scorer(model).predict(texts) == plain
