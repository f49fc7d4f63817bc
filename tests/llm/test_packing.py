import itertools
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paysight.llm import packing as P


def sound(lengths, capacities):
    bins, offsets, final = P.pack(lengths, capacities)
    content = [[] for _ in final]
    for n, b, o in zip(lengths, bins, offsets):
        content[b].append((o, n))
    for parts, capacity in zip(content, final):
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert parts and end <= capacity and capacity == min(c for c in capacities if c >= end)
    return final


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 64), max_size=60), st.sets(st.sampled_from([8, 16, 24, 32, 48]), max_size=4))
def test_every_length_is_placed_once_and_bins_fit(lengths, more):
    sound(lengths, tuple(sorted(more | {64})))


def optimum(lengths, capacities):
    """Least cost over all ways to group the lengths."""

    def groupings(rest):
        if not rest:
            yield []
            return
        for size in range(len(rest)):
            for others in itertools.combinations(range(1, len(rest)), size):
                group = [rest[0], *(rest[k] for k in others)]
                left = [x for k, x in enumerate(rest) if k and k not in others]
                for tail in groupings(left):
                    yield [group, *tail]

    cost = lambda g: min((P.bin_cost(c) for c in capacities if c >= sum(g)), default=10**9)
    return min(sum(map(cost, g)) for g in groupings(lengths)) if lengths else 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=6))
def test_cost_is_near_the_brute_force_optimum(lengths):
    capacities = (40, 64, 100)
    got = sum(P.bin_cost(c) for c in sound(lengths, capacities))
    assert got <= 1.7 * optimum(lengths, capacities)


def test_downsizing_and_joint_choice():
    assert P.pack([10], (16, 64))[2] == [16]
    assert sorted(P.pack([60, 4, 16], (16, 64))[2]) == [16, 64]


def test_documents_of_every_kind(spark, edge_docs):
    docs = P.word_lengths(edge_docs)
    words = {1: [1], 2: [1], 3: [1], 4: [60_001], 5: [10, 10, 11]}
    rows = P.pack_documents(docs, "n_words", group_parts=4).collect()
    per_doc = Counter()
    for r in rows:
        per_doc[r.doc_id] += r.length
        assert r.start == r.part * 4096 and 0 <= r.length <= 4096 and r.offset + r.length <= r.capacity
    for doc_id, lengths in words.items():
        assert per_doc[doc_id] == sum(lengths)
    full = Counter()
    for r in rows:
        full[r.bin_id, r.capacity] += r.length
    assert all(n <= capacity for (_, capacity), n in full.items()) and len({b for b, _ in full}) == len(full)


def test_result_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    a, b = (sorted(map(tuple, P.pack_documents(P.word_lengths(d), "n_words", group_parts=50).collect())) for d in (docs, docs.repartition(7)))
    assert a == b


@pytest.mark.parametrize("length,parts", [(None, 1), (-5, 1), (0, 1), (4096, 1), (4097, 2), (20_000, 5)])
def test_part_counts(spark, length, parts):
    df = spark.createDataFrame([(1, length)], "doc_id long, n long")
    assert P.pack_documents(df, "n").count() == parts


def test_empty_table(spark):
    assert P.pack_documents(spark.createDataFrame([], "doc_id long, n long"), "n").count() == 0
