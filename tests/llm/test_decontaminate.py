import hashlib
import re

import pytest

from paysight.llm import decontaminate as D

SF = "/root/testdata/sf0.001"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(docs, items, width=13):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            size = min(width, len(v))
            grams = {tuple(v[k : k + size]) for k in range(len(v) - size + 1)} if size and item_id is not None else set()
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in grams:
                    hit |= set(range(k, k + size))
                    found.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = [tuple(r) for r in D.op8_benchmark_decontamination(spark, SF).collect()]
    assert sorted(got) == sorted(plain(docs, items))
    assert any(r[5] for r in got)


ITEMS = [(1, "one two three"), (2, "Three, FOUR five"), (2, "three four five"), (3, None), (None, "eight nine"), (4, ""), (5, "...")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


DOCS = [(1, "One two three four five six"), (2, "one two; three? four, FIVE!"), (3, None), (4, ""), (5, "eight nine"), (6, "x " * 200 + "one two three"), (None, "one two three"), (1, "One two three four five six")]


@pytest.mark.parametrize("block", [D.MAX_BLOCK_BYTES, 12])
def test_small_items_nulls_and_blocks(spark, make_docs, items, block):
    scanned = D.scan_documents(make_docs(DOCS), items, max_block_bytes=block, scan_col="s").collect()
    expected = [(d, n, hit, sorted({str(i) for i, t in ITEMS if i is not None and 0 < len(words(t)) and any(words(x)[k : k + len(words(t))] == words(t) for k in range(len(words(x))))})) for (d, x), (_, n, hit, _, _, _) in zip(DOCS, plain(DOCS, ITEMS))]
    got = [(r.doc_id, r.s.n_words, sum(s.last_word - s.first_word + 1 for s in r.s.spans), list(r.s["items"])) for r in scanned]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_edges_and_empty_tables(spark, edge_docs, make_docs, items):
    assert D.drop_contaminated(edge_docs, items).count() == edge_docs.count()
    assert D.drop_contaminated(make_docs([]), items).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.drop_contaminated(edge_docs, none).columns == edge_docs.columns
    assert D.drop_contaminated(edge_docs, none).count() == edge_docs.count()


def test_contaminated_rows_go_and_clean_ones_stay(make_docs, items):
    kept = sorted(r.doc_id for r in D.drop_contaminated(make_docs(DOCS), items).collect())
    assert kept == [3, 4, 5, 6]  # 3 hit words among 203 are less than one in twenty


def test_spans_are_cut_out(make_docs, items):
    got = {r.doc_id: r.text for r in D.remove_spans(make_docs(DOCS), items).collect()}
    assert got[1] == " six" and got[2] == "!" and got[3] is None and got[5] == "eight nine"
    assert got[6] == "x " * 200


def test_memory_of_a_block_is_bounded():
    rng = __import__("random").Random(5)
    for letters, width in (("abcdefgh", 1), ("abcdefghijklmnopqrstuvwxyz", 6)):
        items = [(str(k), " ".join("".join(rng.choices(letters, k=width)) for _ in range(rng.choice([1, 5, 40, 300])))) for k in range(3000)]
        size = sum(len(t) + len(i) for i, t in items)
        windows = D.Windows(items)
        assert windows.nbytes <= 11 * size + 8 * len(items) + (1 << 14)
        import pickle

        assert len(pickle.dumps(windows)) <= 11 * size + 8 * len(items) + (1 << 15)


def test_equal_hashes_are_told_apart_by_words(monkeypatch):
    monkeypatch.setattr(D, "xxh64_intdigest", lambda word: 7)  # every window of one size has the same hash
    items = [("1", "a b"), ("2", "b c"), ("3", "a b"), ("4", "c"), ("5", " ".join("abcdefghijklmno"))]
    for text in ("a b c", "b a", "x a b y b c", "c", "d", "", " ".join("xabcdefghijklmnoabc")):
        got = D.Windows(items).scan(text.encode())
        _, n, hit, found, _, _ = plain([(0, text)], items)[0]
        names = sorted({i for i, t in items if plain([(0, text)], [(i, t)])[0][3]})
        assert (got["n_words"], sum(s["last_word"] - s["first_word"] + 1 for s in got["spans"]), got["items"]) == (n, hit, names) and len(names) == found
    assert D.Windows([]).scan(b"a b") == {"n_words": 2, "spans": [], "items": []}
