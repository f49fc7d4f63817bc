import zlib

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paysight.llm import quality as Q

SF = "/root/testdata/sf0.01"


def test_query_columns_folds_and_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in Q.op2_quality_classifier(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()
    assert set(rows) == {r.doc_id for r in docs}
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for k, r in rows.items())
    held = [(rows[x.doc_id].predicted, x.quality) for x in spark.read.parquet(f"{SF}/labels.parquet").collect() if rows[x.doc_id].held_out]
    assert sum(a == b for a, b in held) / len(held) >= 0.95


def test_labels_of_the_held_out_fold_teach_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", Q.text_statistics(F.col("text")).alias("stats"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (Q.learn_quality(docs, x) for x in (labels, turned))
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.share, b.share)


def test_sums_do_not_depend_on_partitions(spark):
    rows = spark.range(3000).select(F.transform(F.sequence(F.lit(1), F.lit(len(Q.STATISTICS))), lambda k: F.sin(F.col("id") * k)).alias("stats"), (F.col("id") % 3 == 0).cast("int").alias("label"), F.col("id"))
    one, many = (Q.fit_quality(x, F.col("id") % 4 == 0) for x in (rows.repartition(1), rows.repartition(7)))
    assert np.allclose(one.weights, many.weights, rtol=1e-6, atol=1e-8)


def test_random_features_approximate_the_gaussian_kernel(spark):
    rng = np.random.default_rng(0)
    size = len(Q.STATISTICS)
    errors = []
    for x, y in zip(rng.standard_normal((50, size)), rng.standard_normal((50, size))):
        model = Q.QualityModel(np.zeros(size), np.ones(size), rng.standard_normal((size, Q.FEATURES)) / np.sqrt(size), rng.uniform(0, 2 * np.pi, Q.FEATURES), None, None, None)
        z = model.features(np.array([x, y]))[:, :-1]
        errors.append(z[0] @ z[1] / Q.FEATURES - np.exp(-((x - y) ** 2).sum() / (2 * size)))
    assert abs(np.mean(errors)) < 0.05 and np.std(errors) < 0.2


@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 9)), min_size=1, max_size=12))
def test_isotonic_is_monotone_and_no_worse_than_any_step(points):
    values, weights = [v for v, _ in points], [float(w) for _, w in points]
    fit = Q.isotonic(values, weights)
    assert all(a <= b + 1e-12 for a, b in zip(fit, fit[1:])) and len(fit) == len(values)
    loss = lambda f: sum(w * (v - x) ** 2 for v, w, x in zip(values, weights, f))
    for cut in range(len(values) + 1):
        for low, high in ((0.2, 0.7), (0.0, 1.0), (0.5, 0.5)):
            assert loss(fit) <= loss([low] * cut + [high] * (len(values) - cut)) + 1e-9


def test_edges_and_missing_labels(spark, edge_docs, make_docs):
    stats = edge_docs.select("doc_id", Q.text_statistics(F.col("text")).alias("stats"))
    labels = "doc_id long, quality int"
    for given_labels, expected in (([], 1), ([(1, 1), (2, 1), (4, 1)], 1), ([(k, 0) for k in range(8)], 0), ([(4, None), (5, 7)], 1)):
        model = Q.learn_quality(stats, spark.createDataFrame(given_labels, labels))
        scores = [r.s for r in stats.select(Q.quality_score(F.col("stats"), model, spark).alias("s")).collect()]
        assert len(scores) == edge_docs.count() and all(0 <= s <= 1 and int(s >= 0.3) == expected for s in scores)
    mixed = Q.learn_quality(stats, spark.createDataFrame([(k, k % 2) for k in range(8)], labels))
    assert all(0 <= r.s <= 1 for r in stats.select(Q.quality_score(F.col("stats"), mixed, spark).alias("s")).collect())
    empty = make_docs([]).select("doc_id", Q.text_statistics(F.col("text")).alias("stats"))
    assert empty.select(Q.quality_score(F.col("stats"), mixed, spark)).count() == 0
