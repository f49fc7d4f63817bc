import math

import pytest
from pyspark.sql import functions as F

from paysight.llm import topk as T

SF = "/root/testdata/sf0.001"


def plain(rows, k=5):
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in ok]
    out = []
    for q, a in whole:
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in T.op10_topk_search(spark, SF).collect()) == plain(rows)


@pytest.mark.parametrize("shard_rows,block", [(8192, 1024), (40, 2)])
def test_ties_nulls_copies_and_dimensions(spark, shard_rows, block):
    rows = [(i, [float(i % 7) / 4, 1.0, -0.3]) for i in range(160)]  # many ties
    rows += [(3, [float("nan"), 1.0, 1.0]), (200, None), (201, [None, 1.0, 1.0]), (202, [float("inf"), 0.0, 0.0]), (None, [9.0, 9.0, 9.0])]
    rows += [(50, rows[50][1]), (7, rows[7][1]), (300, [1.0, 2.0]), (301, [5.0, 2.0]), (350, [1.0]), (400, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, shard string")
    got = T.top_k(df.select("*", T.quantised(F.col("embedding")).alias("vector")), F.col("vec_id") % 50 == 0, shard_rows=shard_rows, block_queries=block)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**20 + i), float(2**21 - 3 * i)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = T.top_k(df.select("vec_id", T.quantised(F.col("embedding")).alias("vector")), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows)


def test_empty_table_and_lone_query(spark):
    empty = spark.createDataFrame([], "vec_id long, vector array<double>")
    assert T.top_k(empty, F.col("vec_id") % 50 == 0).count() == 0
    lone = spark.createDataFrame([(50, [1.0])], "vec_id long, vector array<double>")
    assert T.top_k(lone, F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("shard_rows,block", [(8192, 1024), (3, 1)])
def test_repeated_candidates_count_each(spark, shard_rows, block):
    # 7 twice, 8 with two vectors of one score for either query, 9 three times
    rows = [(50, [1.0, 0.0]), (100, [2.0, 0.0]), (7, [9.0, 1.0]), (7, [9.0, 1.0]), (8, [8.0, 1.0]), (8, [8.0, 2.0]), *[(9, [7.0, 0.0])] * 3, (10, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    got = T.top_k(df, F.col("vec_id") % 50 == 0, shard_rows=shard_rows, block_queries=block)
    want = [(q, r, i, s * q // 50) for q in (50, 100) for r, (i, s) in enumerate([(7, 9), (7, 9), (8, 8), (8, 8), (9, 7)], 1)]
    assert sorted(tuple(r) for r in got.collect()) == want
