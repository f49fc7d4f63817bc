import hashlib
import re

import pytest
from pyspark.sql import functions as F

from paysight.llm import exact_dedup as E
from paysight.llm.common import Scratch


def plain(rows):
    norm = [re.sub(r"[\x20\x09-\x0d]+", " ", r[1] or "") for r in rows]
    out = []
    for row, text in zip(rows, norm):
        ids = [r[0] for r, t in zip(rows, norm) if t == text]
        keep = min((i for i in ids if i is not None), default=None)
        out.append((row[0], keep, len(ids), row[0] == keep, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


# Spark's hash; one with four values only, so that chains are long; one that leaves everything in one chain.
KEYS = [F.xxhash64, lambda t: F.shiftleft(F.length(t).cast("long") % 4, 62), lambda t: F.lit(7).cast("long")]


@pytest.mark.parametrize("key", KEYS)
@pytest.mark.parametrize("capacity", [E.BUCKET_BYTES, 300])
def test_edges_equal_brute_force(edge_docs, edge_rows, key, capacity):
    assert got(E.exact_duplicates(edge_docs, capacity=capacity, key=key)) == plain(edge_rows)


@pytest.mark.parametrize("capacity", [E.BUCKET_BYTES, 200])
def test_copies_collisions_and_a_hot_text(make_docs, capacity):
    rows = [(k, f"text {k % 40}  of\t{k % 3}\n") for k in range(200)] + [(k, "hot  text\x0b here") for k in range(500, 200, -1)]
    rows += [(k, f"text {k % 40} of {k % 3} ") for k in range(600, 620)] + [(700, "hot text\x1c here")]
    docs = make_docs(rows).repartition(5)
    for key in (F.xxhash64, KEYS[1]):
        assert got(E.exact_duplicates(docs, capacity=capacity, key=key)) == plain(rows)


def test_all_ids_null_and_empty_table(make_docs):
    rows = [(None, "a  b"), (None, "a b"), (None, "c")]
    assert got(E.exact_duplicates(make_docs(rows))) == plain(rows)
    assert E.exact_duplicates(make_docs([])).count() == 0


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("h"), F.lit(2).cast("long").alias("n"), F.lit(100).cast("long").alias("n_bytes"))
    index, buckets = E.build_index(keys, Scratch(spark, "t"), capacity=6000)
    rows = index.collect()
    assert len(rows) == 5000 and len({r.h for r in rows}) == 5000
    loads, depths = {}, {r.depth for r in rows}
    for r in rows:
        assert (r.h % 2**64) >> (64 - r.depth) == r.bucket
        loads[r.depth, r.bucket] = loads.get((r.depth, r.bucket), 0) + 264
    assert len(loads) == buckets and max(loads.values()) <= 6000 and len(depths) > 1
    # no bucket covers another: the sizes of their ranges add up to at most all hash values
    assert sum(2.0**-d for d, _ in loads) <= 1


def test_main_path_has_no_python(edge_docs):
    plan = E.exact_duplicates(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
