import os

import pytest
from pyspark.sql import functions as F

from paysight.sources.files import (
    read_bronze,
    read_survey_csv,
    read_survey_years,
    read_year_dir,
    write_bronze,
    write_report,
    write_table,
)
from paysight.sources.models import requests_frame
from paysight.sources.tables import survey_view

SF_SMALL = "/root/testdata/sf0.001"



def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_quotes_and_newlines(spark, tmp_dir):
    p = os.path.join(tmp_dir, "a.csv")
    _write(p, 'ResponseId,Country,ConvertedCompYearly\n1,"a ""q"" b",NA\n2,"line one\nline two",12.5\n')
    df = read_survey_csv(spark, p, year=2021)
    rows = df.orderBy("ResponseId").collect()
    assert len(rows) == 2
    assert rows[0]["Country"] == 'a "q" b'
    assert rows[1]["Country"] == "line one\nline two"
    assert rows[0]["ConvertedCompYearly"] is None and rows[1]["ConvertedCompYearly"] == 12.5
    assert rows[0]["SurveyYear"] == 2021
    assert dict(df.dtypes)["ResponseId"] == "string"


def test_csv_binds_by_header_name(spark, tmp_dir):
    p1 = os.path.join(tmp_dir, "y1.csv")
    p2 = os.path.join(tmp_dir, "y2.csv")
    _write(p1, "Country,Age\nDE,20\n")
    _write(p2, "Age,Country,Extra\n30,FR,x\n")
    df = read_survey_years(spark, {2021: p1, 2022: p2})
    rows = {r["SurveyYear"]: (r["Country"], r["Age"]) for r in df.collect()}
    assert rows == {2021: ("DE", "20"), 2022: ("FR", "30")}
    assert df.where(F.col("SurveyYear") == 2021).first()["Extra"] is None


def test_null_tokens_and_strict_columns(spark, tmp_dir):
    p = os.path.join(tmp_dir, "n.csv")
    _write(p, "Country,Age\nNA,20\n")
    row = read_survey_csv(spark, p, columns=["Age", "Country"], null_tokens=["NA"]).first()
    assert row["Country"] is None and row["Age"] == "20"


def test_bronze_round_trip_prunes_years(spark, tmp_dir):
    df = survey_view(spark, SF_SMALL)
    out = os.path.join(tmp_dir, "bronze")
    write_bronze(df, out)
    back = read_bronze(spark, out, years=[1996])
    assert back.count() == df.where(F.col("SurveyYear") == 1996).count()
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(SurveyYear" in plan
    yd = os.path.join(tmp_dir, "one_year")
    write_table(df.drop("SurveyYear"), yd, partitions=2)
    assert read_year_dir(spark, yd, 2021).first()["SurveyYear"] == 2021
    rp = os.path.join(tmp_dir, "report")
    write_report(spark.createDataFrame([("n", 1.0)], "metric string, value double"), rp)
    assert spark.read.json(rp).count() == 1


def test_requests_frame_schema(spark):
    df = requests_frame(spark, [{"YearsCodeProNum_imp": 3.0, "CountryGrouped": "DE"}])
    assert df.first()["EdLevel"] is None
    assert dict(df.dtypes)["YearsCodeProNum_imp"] == "double"


def test_scan_pushdown_and_pruning(spark):
    from paysight.operators.filters import positive
    from paysight.sources.tables import load_table

    o = load_table(spark, SF_SMALL, "orders")
    q = positive(o, "o_totalprice").select("o_orderkey", "o_totalprice")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,0.0)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_batch_and_stream_layouts_do_not_share_a_path(spark, tmp_path):
    from paysight.sources.files import write_bronze
    from paysight.streaming.landing import land_files

    raw = tmp_path / "survey_2021.csv"
    raw.write_text("ResponseId,Country,ConvertedCompYearly\n1,A,10\n2,B,20\n")
    batch, stream = str(tmp_path / "batch"), str(tmp_path / "stream")
    rows = read_survey_csv(spark, str(raw), year=2021)
    write_bronze(rows, batch)
    write_bronze(rows, batch)  # the same layout again is fine
    land_files(spark, [str(raw)], stream, 0)
    land_files(spark, [str(raw)], stream, 0)
    assert spark.read.parquet(batch).count() == spark.read.parquet(stream).count() == 2
    with pytest.raises(ValueError, match="another layout"):
        land_files(spark, [str(raw)], batch, 1)
    with pytest.raises(ValueError, match="another layout"):
        write_bronze(rows, stream)
