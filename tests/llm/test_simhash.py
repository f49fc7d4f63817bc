import re

import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paysight.llm import simhash as S
from paysight.llm.common import Scratch
from paysight.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, bits):
    label = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [a if x == b else x for x in label]
    least = {}
    for i, x in zip(ids, label):
        if i is not None:
            least[x] = min(i, least.get(x, i))
    return [least.get(x) for x in label]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_fingerprint(r.text) for r in docs]
    expected = list(zip([r.doc_id for r in docs], [f"{p:016x}" for p in prints], plain_components([r.doc_id for r in docs], prints, 4)))
    got = [tuple(r) for r in S.op7_simhash_dedup(spark, SF).collect()]
    assert sorted(got) == sorted(expected)


def test_edges(edge_docs, edge_rows):
    got = [(r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in S.near_duplicates(edge_docs).collect()]
    prints = [plain_fingerprint(r[1]) for r in edge_rows]
    expected = list(zip([r[0] for r in edge_rows], prints, plain_components([r[0] for r in edge_rows], prints, 4)))
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_empty_table_and_one_row(make_docs):
    assert S.near_duplicates(make_docs([])).count() == 0
    assert S.keep_one(make_docs([])).count() == 0
    assert [r.component_id for r in S.near_duplicates(make_docs([(9, "alone")])).collect()] == [9]


def test_keep_one_keeps_the_smallest_id_and_all_columns(edge_docs):
    kept = S.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    rows = kept.collect()
    # ids 1, 2, 3 and the null one have no words: one of them stays, the smallest id
    assert sorted(r.doc_id or -1 for r in rows) == [-1, 1, 4, 5, 5, 6, 7]
    assert all(r._row == "y" and r.found == "x" for r in rows)


def test_null_ids_only(make_docs):
    docs = make_docs([(None, "same text"), (None, "same text")])
    assert [r.component_id for r in S.near_duplicates(docs).collect()] == [None, None]
    assert S.keep_one(docs).count() == 1


def _walk(rng, n, flips):
    """Fingerprints that step away from each other by a few bits: long chains and crowded buckets."""
    out = [int(rng.integers(0, 2**63))]
    for _ in range(n - 1):
        x = out[int(rng.integers(0, len(out)))]
        for b in rng.integers(0, 64, int(rng.integers(1, flips + 1))):
            x ^= 1 << int(b)
        out.append(x)
    return sorted(set(out))


def _signed(x):
    return x - 2**64 if x >= 2**63 else x


def _check_links(spark, prints, bits):
    rows = [(_signed(p), k) for k, p in enumerate(prints)]
    classes = spark.createDataFrame(rows, "fp long, rep long")
    found = connected_components(S.links(classes, bits, len(rows)), Scratch(spark, "test"))
    root = {r.node.rep: r.root.rep for r in found.collect()}
    expected = plain_components(list(range(len(prints))), prints, bits)
    assert [root.get(k, k) for k in range(len(prints))] == expected


def test_links_find_every_pair(spark):
    rng = np.random.default_rng(7)
    for bits in (0, 1, 3, 4, 6):
        _check_links(spark, _walk(rng, 150, bits + 2), bits)


def test_crowded_buckets_are_split_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(8)
    near = {int(rng.integers(0, 2**63)) & ~0xFFFF | int(x) for x in rng.integers(0, 2**16, 1)}
    base = near.pop()
    prints = sorted({base ^ (int(x) & 0x3FF) for x in rng.integers(0, 1024, 400)} | set(_walk(rng, 60, 5)))
    _check_links(spark, prints, 4)


def test_a_crowded_bucket_is_dealt_to_bounded_tasks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_ROWS", 128)
    monkeypatch.setattr(S, "TASK_ROWS", 1 << 15)
    rng = np.random.default_rng(9)
    prints = sorted({0x155 | int(x) << 26 for x in rng.integers(0, 2**37, 4000)})  # two equal segments: one bucket holds all
    classes = spark.createDataFrame([(p, k) for k, p in enumerate(prints)], "fp long, rep long")
    dealt = S.dealt_rows(classes, 4, len(prints))
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) > 10 * len(prints) * 37 / 5 and max(sizes) < 3 * S.TASK_ROWS
    groups = dealt.groupBy("meet").count().agg(F.max("count")).first()[0]
    assert groups <= 2 * 2 * S.BLOCK_ROWS  # two blocks, dealt by hash


def test_groups_are_worked_on_some_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(S, "GROUP_ROWS", 5)
    rng = np.random.default_rng(10)
    batches = [pa.RecordBatch.from_pydict({"meet": sorted(rng.integers(0, 6, 40).tolist()), "own": [True] * 40, "fp": rng.integers(0, 16, 40), "rep": [0] * 40})]
    rows = batches[0].to_pandas()
    parts = [batches[0].slice(k, 7) for k in range(0, 40, 7)]
    got = pa.Table.from_batches(list(S.link_buckets(1)(iter(parts)))).to_pandas()
    for _, own in rows.groupby("meet"):  # what is near within a group ends in one set
        for a in own.fp:
            for b in own.fp:
                assert (int(a) ^ int(b)).bit_count() != 1 or _root(got, a) == _root(got, b)


def _root(edges, x):
    seen, todo = {x}, [x]
    while todo:
        y = todo.pop()
        for a, b in zip(edges.fp, edges.fp2):
            for u, v in ((a, b), (b, a)):
                if u == y and v not in seen:
                    seen.add(v)
                    todo.append(v)
    return min(seen)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=7), st.integers(1, 8))
def test_chain_filter_never_drops_a_link(value, flips, bits):
    other = value
    for b in flips:
        other ^= 1 << b
    a, b = (np.array([_signed(x)], np.int64) for x in (value, other))
    if (value ^ other).bit_count() <= bits:
        assert S.within_chain(a, b, bits)[0]
    assert bool(len(S.within(a, b, bits))) == ((value ^ other).bit_count() <= bits)


def test_components_of_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 200), (300, 301), (301, 300)]
    found = connected_components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "test"))
    root = {r.node: r.root for r in found.collect()}
    assert root == {k: 0 for k in range(1, 41)} | {k: 100 for k in range(101, 140)} | {301: 300}


def test_hubs_are_joined_apart(spark, monkeypatch):
    from paysight.llm import components as C

    edges = spark.createDataFrame([(0, k) for k in range(1, 60)] + [(k, k + 100) for k in range(1, 60)] + [(300, 301)], "u long, v long")
    want = {r.node: r.root for r in connected_components(edges, Scratch(spark, "test")).collect()}
    monkeypatch.setattr(C, "HUB_EDGES", 3)
    got = {r.node: r.root for r in connected_components(edges, Scratch(spark, "test")).collect()}
    assert got == want == {k: 0 for k in [*range(1, 60), *range(101, 160)]} | {301: 300}


def test_no_local_checkpoint_or_cross_join(spark):
    plan = S.op7_simhash_dedup(spark, SF)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
