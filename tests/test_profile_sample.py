from pyspark.sql import functions as F

from paysight.operators.profile import corr_long, group_quartiles, histogram, missingness, profile, top_k, trend
from paysight.operators.sample import hash_sample, hash_split, with_split


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]], "x double")
    h = {r["bin"]: r["n"] for r in histogram(df, "x", 5).collect()}
    assert h == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    import numpy as np

    counts, _ = np.histogram(np.arange(11.0), bins=5)
    assert [h[i] for i in range(5)] == list(counts)


def test_missingness(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None), (3, 1.0, "c"), (4, 2.0, "d")], "k int, x double, s string")
    rows = [(r["col"], r["missing"], r["missing_pct"]) for r in missingness(df, 2).collect()]
    assert rows == [("x", 2, 50.0), ("s", 1, 25.0)]


def test_corr_symmetric(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("a"), (F.col("id") * -2 + 3).cast("double").alias("b"))
    c = {(r["a"], r["b"]): r["corr"] for r in corr_long(df, ["a", "b", "missing_col"]).collect()}
    assert round(c[("a", "b")], 12) == -1.0 and c[("a", "b")] == c[("b", "a")]
    assert round(c[("a", "a")], 12) == 1.0


def test_profile_and_trend_exact_vs_sketch(spark):
    rows = [(2020 + i % 3, float(i) if i % 10 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "SurveyYear int, ConvertedCompYearly double")
    exact = {r["SurveyYear"]: r for r in profile(df, by=["SurveyYear"], rel_error=0.0).collect()}
    approx = {r["SurveyYear"]: r for r in profile(df, by=["SurveyYear"], rel_error=1e-4).collect()}
    for y in exact:
        assert exact[y]["n_rows"] == 100
        assert exact[y]["n_salary_null"] == approx[y]["n_salary_null"]
        assert exact[y]["median_salary"] == approx[y]["median_salary"]
    tot = profile(df, rel_error=0.0).first()
    assert tot["n_rows"] == 300 and tot["n_salary_not_null"] == 270
    t = trend(df, rel_error=0.0).collect()
    assert [r["SurveyYear"] for r in t] == [2020, 2021, 2022]


def test_group_quartiles_and_top_k(spark):
    rows = [("big", float(i)) for i in range(1, 101)] + [("mid", float(i)) for i in range(1, 51)] + [("tiny", 1.0)] * 3
    df = spark.createDataFrame(rows, "g string, ConvertedCompYearly double")
    for err in (0.0, 1e-4):
        q = group_quartiles(df, "g", top_n=5, min_count=10, rel_error=err).collect()
        assert [r["g"] for r in q] == ["big", "mid"]
        big = q[0]
        assert (big["p25"], big["median_salary"], big["p75"]) == (25.0, 50.0, 75.0)
        assert big["err_low"] == 25.0 and big["err_high"] == 25.0
    assert [r["g"] for r in top_k(df, "g", 2).collect()] == ["big", "mid"]


def test_hash_split_properties(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    train, test = hash_split(df, "k", 80)
    a = {r[0] for r in train.collect()}
    b = {r[0] for r in test.collect()}
    assert not (a & b) and len(a | b) == 5000
    assert 3800 < len(a) < 4200
    a2 = {r[0] for r in hash_split(df.repartition(7), "k", 80)[0].collect()}
    assert a == a2
    assert with_split(df, "k").where(F.col("split") == "train").count() == len(a)


def test_hash_sample_is_stable(spark):
    df = spark.range(3000).withColumnRenamed("id", "k")
    s1 = [r[0] for r in hash_sample(df, "k", 50).collect()]
    s2 = [r[0] for r in hash_sample(df.repartition(5), "k", 50).collect()]
    assert s1 == s2 and len(s1) == 50


def test_hash_sample_equals_plain_ordered_limit(spark):
    from paysight.functions.buckets import md5_order_key

    df = spark.range(4000).withColumnRenamed("id", "k")
    for n in (1, 37, 1000, 5000):
        got = [r[0] for r in hash_sample(df, "k", n).collect()]
        want = [r[0] for r in df.orderBy(md5_order_key("k"), "k").limit(n).collect()]
        assert got == want


def test_histogram_method_in_profiles(spark):
    rows = [(2020 + i % 3, float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "SurveyYear int, ConvertedCompYearly double")
    exact = {r["SurveyYear"]: r["median_salary"] for r in trend(df, rel_error=0.0).collect()}
    approx = {r["SurveyYear"]: r["median_salary"] for r in trend(df, rel_error=0.01, method="histogram").collect()}
    assert set(exact) == set(approx)
    for y in exact:
        assert abs(exact[y] - approx[y]) <= 0.01 * 3000 * 3 + 3  # rank error 1% of 1000 rows, step 3
    p = profile(df, by=["SurveyYear"], rel_error=0.01, method="histogram").collect()
    assert len(p) == 3
    big = [("a", float(i)) for i in range(500)]
    q = group_quartiles(spark.createDataFrame(big, "g string, ConvertedCompYearly double"), "g", min_count=1, rel_error=0.01, method="histogram").first()
    assert abs(q["median_salary"] - 249.0) <= 5


def test_null_and_repeated_keys_fall_on_exactly_one_side(spark):
    rows = [(None, 1), (None, 2), ("1", 3), ("1", 4), ("2", 5)] + [(str(k % 50), 100 + k) for k in range(400)]
    df = spark.createDataFrame(rows, "k string, v long")
    for key in ("k", ["k", "v"]):
        train, test = hash_split(df, key, 80)
        got = sorted(r["v"] for r in train.union(test).collect())
        assert got == sorted(v for _, v in rows)
        tagged = {r["v"]: r["split"] for r in with_split(df, key, 80).collect()}
        assert {v: "train" for v in (r["v"] for r in train.collect())}.items() <= tagged.items()
        assert all(tagged[r["v"]] == "test" for r in test.collect())


def test_sample_of_null_and_repeated_keys_is_a_total_order(spark):
    from paysight.functions.buckets import md5_order_key

    rows = [(None if k % 5 == 0 else str(k % 7), k) for k in range(300)]
    df = spark.createDataFrame(rows, "k string, v long")
    for n in (1, 10, 75, 299, 400):
        want = [r["v"] for r in df.orderBy(md5_order_key("k"), "k", "v").limit(n).collect()]
        assert [r["v"] for r in hash_sample(df.repartition(6), "k", n).collect()] == want


def test_nan_takes_no_part_in_any_mode(spark):
    from paysight.operators import profile as prof

    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 3.0, *[float("nan")] * 4)], "g string, x double")
    for rel_error, method in ((0.0, "histogram"), (0.01, "histogram"), (0.01, "sketch")):
        by = prof.profile(df, "x", by=["g"], rel_error=rel_error, method=method).first()
        whole = prof.profile(df, "x", rel_error=rel_error, method=method).first()
        assert by["median_salary"] == whole["median_salary"] == 2.0


def test_scatter_counts_every_row(spark):
    from paysight.operators.profile import scatter_bins

    df = spark.range(1000).selectExpr("id * 1.0 AS x", "CASE WHEN id % 10 = 0 THEN NULL WHEN id % 11 = 0 THEN double('NaN') ELSE sqrt(id) END AS y")
    cells = scatter_bins(df, "x", "y", 20).collect()
    assert sum(r["n"] for r in cells) == sum(1 for k in range(1000) if k % 10 and k % 11)
    assert all(0 <= r["x_bin"] < 20 and 0 <= r["y_bin"] < 20 for r in cells)
    assert scatter_bins(df.limit(0), "x", "y").count() == 0
