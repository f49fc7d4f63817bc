import os

from pyspark.sql import functions as F

from paysight.plans import jobs
from paysight.plans.silver import SilverParams
from paysight.sources.tables import survey_view
from paysight.streaming.landing import land_stream

SF_SMALL = "/root/testdata/sf0.001"



def _raw_csv(spark, tmp_dir):
    """Survey rows from the driver tables written as one CSV file per year."""
    s = survey_view(spark, SF_SMALL)
    paths = {}
    for y in (1996, 1997):
        out = os.path.join(tmp_dir, f"raw{y}")
        s.where(F.col("SurveyYear") == y).drop("SurveyYear").coalesce(1).write.option("header", True).csv(out)
        name = [f for f in os.listdir(out) if f.endswith(".csv")][0]
        paths[y] = os.path.join(out, name)
    return s, paths


def test_stage_jobs_end_to_end(spark, tmp_dir):
    s, raw = _raw_csv(spark, tmp_dir)
    bronze = os.path.join(tmp_dir, "bronze")
    prof = {r["SurveyYear"]: r["n_rows"] for r in jobs.bronze(spark, raw, bronze).collect()}
    want = {r["SurveyYear"]: r["count"] for r in s.where(F.col("SurveyYear").isin(1996, 1997)).groupBy("SurveyYear").count().collect()}
    assert prof == want
    silver = os.path.join(tmp_dir, "silver")
    sv = jobs.silver_job(spark, bronze, silver, SilverParams(min_country=5))
    assert sv.count() > 0 and "CountryGrouped" in sv.columns
    gold = os.path.join(tmp_dir, "gold")
    g = jobs.gold_job(spark, silver, gold, os.path.join(tmp_dir, "pipe"))
    assert g.columns == ["SurveyYear", "ResponseId", "features", "ConvertedCompYearly"]
    tables = jobs.eda_job(spark, silver, os.path.join(tmp_dir, "eda"))
    assert {"missing_top20", "salary_hist_raw", "quartiles", "trend", "report", "corr"} <= set(tables)


def test_stream_landing_is_incremental(spark, tmp_dir):
    s, raw = _raw_csv(spark, tmp_dir)
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    bronze = os.path.join(tmp_dir, "bronze_stream")
    ckpt = os.path.join(tmp_dir, "ckpt_stream")
    os.link(raw[1996], os.path.join(inbox, "survey_1996.csv"))
    land_stream(spark, inbox, bronze, ckpt)
    assert spark.read.parquet(bronze).count() == s.where(F.col("SurveyYear") == 1996).count()
    os.link(raw[1997], os.path.join(inbox, "survey_1997.csv"))
    land_stream(spark, inbox, bronze, ckpt)
    landed = spark.read.parquet(bronze)
    counts = {r["SurveyYear"]: r["count"] for r in landed.groupBy("SurveyYear").count().collect()}
    assert counts == {r["SurveyYear"]: r["count"] for r in s.where(F.col("SurveyYear").isin(1996, 1997)).groupBy("SurveyYear").count().collect()}
    assert dict(landed.dtypes)["ConvertedCompYearly"] == "double"


def test_score_job_round_trip(spark, tmp_dir):
    from paysight.operators.models import LR_V1, train_lr, with_label
    from paysight.sources.models import save_model

    s, raw = _raw_csv(spark, tmp_dir)
    bronze = os.path.join(tmp_dir, "bronze_s")
    jobs.bronze(spark, raw, bronze)
    silver = os.path.join(tmp_dir, "silver_s")
    sv = jobs.silver_job(spark, bronze, silver, SilverParams(min_country=5))
    gold = os.path.join(tmp_dir, "gold_s")
    pipe = os.path.join(tmp_dir, "pipe_s")
    g = jobs.gold_job(spark, silver, gold, pipe)
    model_path = os.path.join(tmp_dir, "lr_s")
    save_model(train_lr(with_label(g), LR_V1), model_path)
    requests = os.path.join(tmp_dir, "requests")
    sv.select(
        "ResponseId", "YearsCodeProNum_imp", "CountryGrouped", "EdLevel", "RemoteWork", "OrgSize",
        F.lit("").alias("LanguageHaveWorkedWith"), "DatabaseHaveWorkedWith",
    ).write.parquet(requests)
    out = jobs.score_job(spark, requests, pipe, model_path, "lr", os.path.join(tmp_dir, "scores"))
    assert out.count() == sv.count()
    assert out.where(F.col("salary_pred").isNull()).count() == 0


def test_retried_landing_batch_replaces_itself(spark, tmp_dir):
    from paysight.streaming.landing import land_files

    s, raw = _raw_csv(spark, tmp_dir)
    bronze = os.path.join(tmp_dir, "bronze_retry")
    paths = [raw[1996]]
    land_files(spark, paths, bronze, batch_id=0)
    first = spark.read.parquet(bronze).count()
    land_files(spark, paths, bronze, batch_id=0)  # the same batch run again after a failure
    assert spark.read.parquet(bronze).count() == first == s.where(F.col("SurveyYear") == 1996).count()


def test_train_job_saves_versioned_models_and_marks_best(spark, tmp_dir, monkeypatch):
    import paysight.plans.gold as gold_mod
    from paysight.operators.models import LR_V1
    from paysight.sources.models import load_regressor

    small_gbt = {"maxIter": 3, "maxDepth": 3, "stepSize": 0.1, "subsamplingRate": 0.8, "seed": 42}
    monkeypatch.setattr(gold_mod, "SETTINGS", {"v1": (LR_V1, small_gbt, False)})
    s, raw = _raw_csv(spark, tmp_dir)
    bronze = os.path.join(tmp_dir, "bronze_t")
    jobs.bronze(spark, raw, bronze)
    silver = os.path.join(tmp_dir, "silver_t")
    jobs.silver_job(spark, bronze, silver, SilverParams(min_country=5))
    gold = os.path.join(tmp_dir, "gold_t")
    jobs.gold_job(spark, silver, gold, os.path.join(tmp_dir, "pipe_t"))
    models = os.path.join(tmp_dir, "models")
    metrics_path = os.path.join(tmp_dir, "metrics")
    m = jobs.train_job(spark, gold, models, "v1", metrics_path)
    rows = {r["model"]: r for r in spark.read.parquet(metrics_path).collect()}
    assert set(rows) == {"lr_v1", "gbt_v1"}
    assert sum(r["best"] for r in rows.values()) == 1
    best = min(rows.values(), key=lambda r: (r["rmse_log"], 0 if r["model"].startswith("lr") else 1))
    assert best["best"]
    assert load_regressor(os.path.join(models, "lr_v1"), "lr") is not None
    assert load_regressor(os.path.join(models, "gbt_v1"), "gbt") is not None
    assert m.count() == 2


def test_raw_rows_are_scored_by_a_saved_silver_fit(spark, tmp_dir):
    from paysight.operators.models import LR_V1, train_lr, with_label
    from paysight.plans.silver import SilverModel
    from paysight.sources.models import save_model

    s, raw = _raw_csv(spark, tmp_dir)
    at = lambda name: os.path.join(tmp_dir, f"{name}_r")
    jobs.bronze(spark, raw, at("bronze"))
    sv = jobs.silver_job(spark, at("bronze"), at("silver"), SilverParams(min_country=5), model_path=at("fit"))
    g = jobs.gold_job(spark, at("silver"), at("gold"), at("pipe"))
    save_model(train_lr(with_label(g), LR_V1), at("lr"))
    model = SilverModel.load(spark, at("fit"))
    bronze = spark.read.parquet(at("bronze"))
    again = model.transform(bronze).select(sorted(sv.columns))
    assert sorted(map(str, again.collect())) == sorted(map(str, sv.select(sorted(sv.columns)).collect()))
    unseen = model.transform(bronze.limit(1).withColumn("Country", F.lit("Nowhere")), filter_rows=False)
    assert unseen.first()["CountryGrouped"] == "Other"
    out = jobs.score_job(spark, at("bronze"), at("pipe"), at("lr"), "lr", at("scores"), silver_model=at("fit"))
    assert out.count() == bronze.count() and out.where(F.col("salary_pred").isNull()).count() == 0
    tables = jobs.eda_job(spark, at("silver"), at("eda"), at("gold"), {"lr_v1": at("lr")})
    n = g.count()
    assert {t.agg(F.sum("n")).first()[0] for k, t in tables.items() if k.startswith("lr_v1_")} == {n}


def test_landing_one_year_leaves_the_others(spark, tmp_dir):
    from paysight.sources.files import read_bronze, write_bronze

    s, _ = _raw_csv(spark, tmp_dir)
    path = os.path.join(tmp_dir, "bronze_years")
    for year in (1996, 1997, 1996):  # a year landed again replaces itself
        write_bronze(s.where(F.col("SurveyYear") == year), path)
    got = {r[0]: r[1] for r in read_bronze(spark, path).groupBy("SurveyYear").count().collect()}
    want = {r[0]: r[1] for r in s.where(F.col("SurveyYear").isin(1996, 1997)).groupBy("SurveyYear").count().collect()}
    assert got == want
