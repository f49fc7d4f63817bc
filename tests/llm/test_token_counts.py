import pytest
from tokenizers import Tokenizer

from paysight.llm import token_counts as C

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(C.tokenizer_file())


def test_query_equals_the_library_on_whole_texts(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = C.op5_token_counts(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        n = len(library.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 2048)


TEXTS = [
    "x<|endoftext|>y <|startoftext|> <|endoftext|><|endoftext|>",
    "I'LL don't it's ΑΣ ΟΔΟΣ İstanbul ﬀ ß Å é ́ a",
    "a\x1cb\x1dc \x85 d\xa0e f　g ​ h﻿i",
    "2024-01-01 12:30 3.14159 $%&/()=?",
    "北京 こんにちは 한국어 😀😀",
    "\x00\x01 control \x7f",
]


def test_hard_texts_edges_and_a_small_cache(make_docs, edge_rows, library, monkeypatch):
    monkeypatch.setattr(C, "CACHE_RUNS", 3)
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [r[:2] for r in edge_rows]
    got = C.count_tokens(make_docs(rows), frequent=4, sample_rows=2).collect()
    expected = [(i, t, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert sorted([(r.doc_id, r.text, r.n_tokens) for r in got], key=repr) == sorted(expected, key=repr)


def test_empty_table(make_docs):
    assert C.count_tokens(make_docs([])).count() == 0


def test_plan_has_no_shuffle(spark):
    plan = C.op5_token_counts(spark, SF)._jdf.queryExecution().toString()
    assert "Exchange" not in plan
