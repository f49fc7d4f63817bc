"""CSV files read in byte ranges, profiles kept over landings, indices of many labels."""

import os

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from paysight.operators.label_index import index_column, label_ranks
from paysight.operators.profile import profile
from paysight.operators.rolling import bin_state, land_state, merged_state, profile_from_state
from paysight.sources.csv_splits import csv_records, read_csv_splits
from paysight.sources.files import read_survey_csv

FIELDS = ["plain", '"quoted, with comma"', '"two\nlines"', '"a ""doubled"" quote"', '""', "", '"ends with quote"""', '"\n\n\n"', "é北", '"' + "long " * 200 + '\n"']


def write(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "a.csv"), "w", newline="") as f:
        f.write(text)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("split", [None, 97, 700, 1 << 20])
def test_ranges_give_the_rows_of_one_task(spark, tmp_dir, end, split):
    lines = [f"{k},{FIELDS[k % len(FIELDS)]},{FIELDS[(k * 7 + 3) % len(FIELDS)]}" for k in range(400)]
    # Spark takes the first line end it meets for that of the file
    head = 'id,"the\nfirst",b' if end == "\n" else "id,a,b"
    write(tmp_dir, end.join([head, *lines, "", '401,"open at the end",x']) + end)
    one = spark.read.options(header="true", multiLine="true", escape='"').csv(tmp_dir)
    got = read_csv_splits(spark, tmp_dir, split_bytes=split)
    assert got.columns == one.columns and rows(got) == rows(one) and one.count() == 401


def test_several_files_each_with_a_header(spark, tmp_dir):
    for name in ("x", "y"):
        os.makedirs(f"{tmp_dir}/in", exist_ok=True)
        with open(f"{tmp_dir}/in/{name}.csv", "w") as f:
            f.write("a,b\n" + "".join(f'{name}{k},"l1\nl2 {k}"\n' for k in range(50)))
    got = read_csv_splits(spark, f"{tmp_dir}/in", split_bytes=64)
    assert rows(got) == rows(spark.read.options(header="true", multiLine="true", escape='"').csv(f"{tmp_dir}/in")) and got.count() == 100


def test_a_file_is_cut_into_many_tasks(spark, tmp_dir):
    write(tmp_dir, "a,b\n" + "".join(f'{k},"x\n{k}"\n' for k in range(2000)))
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    assert session.read.text(tmp_dir).rdd.getNumPartitions() > 10
    assert csv_records(session, tmp_dir).count() == 2000


def test_survey_reader_takes_a_split_size(spark, tmp_dir):
    write(tmp_dir, 'ResponseId,Country,ConvertedCompYearly\n1,"A\nB",10\n2,NA,x\n3,,"7.5"\n')
    a = read_survey_csv(spark, tmp_dir, year=2021, null_tokens=["NA"])
    b = read_survey_csv(spark, tmp_dir, year=2021, null_tokens=["NA"], split_bytes=16)
    assert a.dtypes == b.dtypes and rows(a) == rows(b)


@pytest.fixture(scope="module")
def pay(spark):
    x = F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 13 == 0, float("nan")).otherwise((F.xxhash64("id") % 100000) / 7.0)
    year = F.when(F.col("id") % 50 == 0, None).otherwise(2020 + F.col("id") % 3).cast("int")
    return spark.range(5000).select("id", year.alias("SurveyYear"), x.alias("ConvertedCompYearly"))


def rounded(df):
    return list(map(repr, rows(df.select("SurveyYear", "n_rows", "n_salary_not_null", "n_salary_null", F.round("mean_salary", 6).alias("m"), "median_salary"))))


def test_two_landings_equal_the_whole(spark, pay, tmp_dir):
    for batch, part in (("a", pay.filter("id < 1700")), ("b", pay.filter("id >= 1700"))):
        land_state(part, tmp_dir, batch)
    state = merged_state(spark, tmp_dir)
    assert rounded(profile_from_state(state, pay)) == rounded(profile(pay, by=["SurveyYear"], rel_error=0.0))
    # a batch landed again replaces its own counts only
    land_state(pay.filter("id >= 1700"), tmp_dir, "b")
    assert rows(merged_state(spark, tmp_dir).select("SurveyYear", "_q_b", "_q_c", "n_rows")) == rows(bin_state(pay).select("SurveyYear", "_q_b", "_q_c", "n_rows"))


def test_a_year_without_a_value_and_an_empty_table(spark, pay, tmp_dir):
    none = pay.limit(0).unionByName(spark.createDataFrame([(1, 2030, None), (2, 2030, None)], pay.schema))
    land_state(none, f"{tmp_dir}/n", "a")
    assert rows(profile_from_state(merged_state(spark, f"{tmp_dir}/n"), none)) == [(2030, 2, 0, 2, None, None)]


def test_median_reads_only_its_bin(spark, pay, tmp_dir):
    land_state(pay, f"{tmp_dir}/s", "a")
    pay.write.parquet(f"{tmp_dir}/rows")
    state = merged_state(spark, f"{tmp_dir}/s")
    from paysight.operators import rolling

    seen = []
    real = rolling.exact_quantiles
    rolling.exact_quantiles = lambda near, *a, **k: (seen.append(near), real(near, *a, **k))[1]
    try:
        profile_from_state(state, spark.read.parquet(f"{tmp_dir}/rows")).collect()
    finally:
        rolling.exact_quantiles = real
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan or "GreaterThanOrEqual(ConvertedCompYearly" in plan
    assert seen[0].count() < pay.count() / 4


def test_ranks_equal_the_indexer(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 17 == 0, None).otherwise(F.concat(F.lit("L"), ((F.col("id") * F.col("id")) % 211).cast("string"))).alias("c")).repartition(7)
    want = StringIndexer(inputCol="c", outputCol="c_idx", handleInvalid="keep").fit(df).transform(df)
    ranks = label_ranks(df, "c")
    assert rows(index_column(df, "c", ranks).select("id", "c", "c_idx")) == rows(want)
    unseen = spark.createDataFrame([(1, "new"), (2, None)], "id long, c string")
    assert {r.c_idx for r in index_column(unseen, "c", ranks).collect()} == {float(ranks.count())}
    assert label_ranks(df.limit(0), "c").count() == 0
    plan = ranks._jdf.queryExecution().toString() + label_ranks(df, "c")._jdf.queryExecution().optimizedPlan().toString()
    assert "partitionBy(label" not in plan
