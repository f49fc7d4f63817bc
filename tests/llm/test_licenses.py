import re

import duckdb
import pytest

from paysight.llm import licenses as L

SF = "/root/testdata/sf0.001"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(text):
    """The base columns by looking at every place."""
    w = words(text)
    found = [(k, label) for label, phrase in L.PHRASES for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]
    places = [k for k, _ in found]
    return len(w), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


TEXTS = [
    "Released under the MIT License.",
    "mit license mit license MIT-License, general public license general public license",
    "This work is licensed, as ever, under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0.",
    "mit  ... LICENSE apache\nlicense",
    "mitlicense general public licenses",
    "licensed under the apache license version 2 0 " * 40,
    "general public mit license public license",
    "permission is hereby granted free of charge to any person obtaining one copy of this software and documentation files",
    "licensed under cc by sa 4 0 4 0 4 0 4 0 4 0 4 0",
    "licensed under the gnu cc by nc 4 0 by nc 4 0 by nc 4 0 by nc",
]


def test_hard_texts_and_edges(make_docs, edge_rows):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [r[:2] for r in edge_rows]
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in L.scan_licenses(make_docs(rows)).collect()]
    assert sorted(got, key=repr) == sorted([(i, *plain(t)) for i, t in rows], key=repr)


def test_method_labels(make_docs):
    got = {r.doc_id: r for r in L.scan_licenses(make_docs(list(enumerate(TEXTS)))).collect()}
    assert got[2].labels == "gpl" and got[3].labels == "cc-by-nc" and got[3].n_base == 0 and got[3].score == 1
    assert got[8].labels == "mit" and 0.7 <= got[8].score < 1
    # a notice whose tail repeats: one diagonal holds all of it
    assert got[9].labels == "cc-by-sa" and got[9].score == 1
    assert got[5].labels == "" and got[5].score == 0
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) for r in got.values() if r.base_labels)


def test_empty_table(make_docs):
    assert L.scan_licenses(make_docs([])).count() == 0


@pytest.mark.parametrize("extra", [[], [(None, None), (1, "mit license"), (1, "mit license")]])
def test_sql_gives_the_same_rows(spark, make_docs, extra):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.union(make_docs([(k, t) for k, t in enumerate(TEXTS)] + extra).select("doc_id", "text"))
    con = duckdb.connect()
    pdf = docs.toPandas()
    pdf["doc_id"] = pdf["doc_id"].astype("Int64")
    con.register("documents", pdf)
    expected = con.execute(L.OP3_SQL).fetchall()
    assert sorted(map(tuple, L.scan_licenses(docs).collect()), key=repr) == sorted(expected, key=repr)


def test_no_python_in_the_plan(spark):
    plan = L.op3_license_scan(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
