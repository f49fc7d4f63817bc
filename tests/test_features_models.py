import math

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from paysight.operators.features import (
    FeatureSpec,
    assemble_and_scale,
    fit_features,
    index_and_encode,
    vocabulary,
)
from paysight.operators.models import (
    LR_V1,
    LR_V2,
    best_model,
    clip_predictions,
    diagnostics,
    evaluate,
    score,
    train_gbt,
    train_lr,
    with_label,
)


def test_index_and_encode_keep(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,), ("a",)], "x string")
    out = index_and_encode(df, "x")
    rows = out.select("x", "x_idx", vector_to_array("x_vec").alias("v")).collect()
    for r in rows:
        assert len(r["v"]) == 4 and sum(r["v"]) == 1.0
    idx = {r["x"]: r["x_idx"] for r in rows}
    assert idx == {"a": 0.0, "b": 1.0, "c": 2.0, None: 3.0}  # ties alphabetical, null in the extra slot


def test_choosers(spark):
    df = spark.createDataFrame([(1.0, 2.0, "x", "y")], "YearsCodeProNum double, YearsCodeProNum_imp double, EdLevel string, LanguageHaveWorkedWith string")
    spec = FeatureSpec.resolve(df)
    assert (spec.numeric, spec.categorical, spec.text) == (["YearsCodeProNum_imp"], ["EdLevel"], ["LanguageHaveWorkedWith"])
    own = FeatureSpec.resolve(df, numeric=["YearsCodeProNum", "YearsCodeProNum_imp"], text=[], vocab_size=5)
    assert (own.numeric, own.text, own.vocab_size) == (["YearsCodeProNum", "YearsCodeProNum_imp"], [], 5)
    for wrong in ({"numeric": ["EdLevel"]}, {"text": ["YearsCodeProNum"]}, {"categorical": ["NoSuchColumn"]}):
        with pytest.raises(ValueError):
            FeatureSpec.resolve(df, **wrong)


def test_vocabulary_min_df_and_order(spark):
    rows = [("a;b",)] * 50 + [("b;b;c",)] * 30 + [("d",)]
    df = spark.createDataFrame(rows, "t string")
    v = {r["token"]: (r["tf"], r["df"], r["rank"]) for r in vocabulary(df, ["t"], vocab_size=2, min_df=0.05).collect()}
    # b: tf 110, df 80; a: tf 50; c: 30; d below min_df
    assert v == {"b": (110, 80, 0), "a": (50, 50, 1)}


def test_scaled_columns_have_unit_sample_std(spark):
    df = spark.range(200).select(
        F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"), F.lit(3.0).alias("c")
    )
    out = assemble_and_scale(df, ["a", "b", "c"])
    arr = out.select(vector_to_array("features").alias("v"))
    stds = arr.agg(*[F.stddev_samp(F.col("v")[i]).alias(f"s{i}") for i in range(3)]).first()
    assert abs(stds["s0"] - 1) < 1e-9 and abs(stds["s1"] - 1) < 1e-9
    assert arr.agg(F.max(F.col("v")[2])).first()[0] == 0.0  # zero variance -> 0


def _survey_like(spark, n=600):
    rows = []
    for i in range(n):
        rows.append(
            (
                i,
                ["DE", "FR", "Other"][i % 3],
                ["BSc", "MSc"][i % 2],
                "Python;SQL" if i % 3 else "Java",
                float(i % 20),
                1000.0 * (1 + i % 20) * (1.5 if i % 2 else 1.0),
            )
        )
    return spark.createDataFrame(
        rows,
        "ResponseId int, CountryGrouped string, EdLevel string, LanguageHaveWorkedWith string, "
        "YearsCodeProNum_imp double, ConvertedCompYearly double",
    )


def test_pipeline_fit_save_load_score(spark, tmp_dir):
    df = _survey_like(spark)
    spec = FeatureSpec.resolve(df)
    model = fit_features(df, spec)
    feats = model.transform(df)
    size = feats.select(F.size(vector_to_array("features"))).first()[0]
    # 3+1 countries, 2+1 levels, 3 tokens, 1 numeric
    assert size == 4 + 3 + 3 + 1
    path = tmp_dir + "/pipe"
    model.write().overwrite().save(path)
    from paysight.sources.models import load_pipeline

    again = load_pipeline(path).transform(df).select("ResponseId", "features").orderBy("ResponseId").collect()
    assert again == feats.select("ResponseId", "features").orderBy("ResponseId").collect()
    labelled = with_label(feats)
    lr = train_lr(labelled, LR_V1)
    req = df.select(
        "ResponseId", "CountryGrouped", "EdLevel", F.lit("").alias("LanguageHaveWorkedWith"), "YearsCodeProNum_imp"
    )
    scored = score(req, model, lr)
    none = score(req.withColumn("LanguageHaveWorkedWith", F.lit(None).cast("string")), model, lr)
    assert scored.select("pred_log").collect() == none.select("pred_log").collect()
    r = scored.first()
    assert abs(r["salary_pred"] - math.expm1(r["pred_log"])) < 1e-6


def test_several_models_score_with_features_made_once(spark):
    df = _survey_like(spark)
    model = fit_features(df, FeatureSpec.resolve(df))
    labelled = with_label(model.transform(df))
    models = {"a": train_lr(labelled, LR_V1), "b": train_lr(labelled, {**LR_V1, "regParam": 0.5})}
    both = score(df, model, models)
    for name, regressor in models.items():
        alone = score(df, model, regressor).select("ResponseId", "pred_log", "salary_pred")
        assert sorted(both.select("ResponseId", f"{name}_pred_log", f"{name}_salary_pred").collect()) == sorted(alone.collect())
    # a scaled vector of each row, not one for each model
    assert both._jdf.queryExecution().optimizedPlan().toString().count("AS features#") == 1


def test_vocabulary_reads_its_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame([(f"a;b{k % 3}", "x;y" if k % 2 else None) for k in range(60)], "t string, u string").repartition(2)
    rows = vocabulary(df.mapInArrow(counted, df.schema), ["t", "u"], vocab_size=3).collect()
    assert len(rows) == 5 and read.value == 60


def _lr_data(spark):
    df = spark.range(1, 500).select(
        (F.col("id") % 50 + 1).cast("double").alias("x"),
    ).withColumn("label", F.log1p(F.col("x") * 123.0 + F.col("x") * F.col("x")))
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(df)


@pytest.mark.parametrize("params", [LR_V1, LR_V2])
def test_lr_closed_form(spark, params):
    df = _lr_data(spark)
    m = train_lr(df, params)
    s = df.agg(
        F.avg("x").alias("mx"),
        F.avg("label").alias("my"),
        F.stddev_pop("x").alias("sx"),
        F.stddev_pop("label").alias("sy"),
        F.corr("x", "label").alias("r"),
    ).first()
    reg, a = params["regParam"], params["elasticNetParam"]
    q = reg / s["sy"]
    w = math.copysign(max(abs(s["r"]) - q * a, 0.0) / (1 + q * (1 - a)), s["r"])
    slope = w * s["sy"] / s["sx"]
    assert abs(m.coefficients[0] - slope) < 1e-8
    assert abs(m.intercept - (s["my"] - slope * s["mx"])) < 1e-8


def test_evaluate_matches_regression_evaluator(spark):
    df = _lr_data(spark)
    pred = train_lr(df, LR_V1).transform(df)
    ev = evaluate(pred).first()
    rmse = RegressionEvaluator(metricName="rmse").evaluate(pred)
    r2 = RegressionEvaluator(metricName="r2").evaluate(pred)
    assert abs(ev["rmse_log"] - rmse) < 1e-10 and abs(ev["r2_log"] - r2) < 1e-10
    assert ev["n_infinite"] == 0


def test_best_model_tie_goes_to_lr(spark):
    m = spark.createDataFrame([("gbt_v1", 0.5), ("lr_v1", 0.5), ("gbt_x", 0.7)], "model string, rmse_log double")
    assert best_model(m).first()["model"] == "lr_v1"


def test_gbt_same_seed_same_layout(spark):
    df = _lr_data(spark).repartitionByRange(2, "x").sortWithinPartitions("x", "label")
    params = {"maxIter": 3, "maxDepth": 3, "stepSize": 0.1, "subsamplingRate": 0.8, "seed": 42}
    a = train_gbt(df, params).transform(df).select("prediction").collect()
    b = train_gbt(df, params).transform(df).select("prediction").collect()
    assert a == b


def test_diagnostics_tables(spark):
    df = _lr_data(spark).withColumn("key", F.monotonically_increasing_id())
    pred = train_lr(df, LR_V1).transform(df)
    d = diagnostics(pred, "key", rel_error=0.0, sample_size=100)
    assert d["scatter_log"].count() == 100
    assert d["residual_hist"].agg(F.sum("n")).first()[0] == df.count()
    clipped = clip_predictions(pred, rel_error=0.0)
    lo, hi = clipped.agg(F.min("prediction_clip"), F.max("prediction_clip")).first()
    q = clipped.approxQuantile("label", [0.01, 0.99], 0.0)
    assert lo >= q[0] - 1e-12 and hi <= q[1] + 1e-12


def test_fit_on_train_only(spark):
    from paysight.operators.sample import hash_split
    from paysight.plans.gold import gold

    df = _survey_like(spark)
    g_all, m_all = gold(df)
    g_train, m_train = gold(df, fit_on="train")
    assert g_train.count() == g_all.count()
    # the indexer of the train-only fit saw only training rows
    train_rows, _ = hash_split(df, "ResponseId", 80)
    idx = m_train.stages[0]
    counts = {r[0]: r[1] for r in train_rows.groupBy("CountryGrouped").count().collect()}
    assert idx.labelsArray[0][0] == max(counts, key=lambda k: (counts[k], [-ord(c) for c in k]))
    with pytest.raises(ValueError):
        gold(df, fit_on="test")


def test_evaluate_clipped(spark):
    from paysight.operators.models import evaluate_clipped

    df = _lr_data(spark)
    pred = train_lr(df, LR_V1).transform(df)
    ev = evaluate_clipped(pred, rel_error=0.0).first()
    assert ev["mae_clipped"] is not None and ev["rmse_clipped"] >= ev["mae_clipped"]
    assert ev["n"] == df.count()


def test_metrics_of_a_constant_label(spark):
    from paysight.operators.models import evaluate

    pred = spark.createDataFrame([(2.0, 1.5), (2.0, 2.5)], "label double, prediction double")
    ev = evaluate(pred).first()
    assert ev["r2_log"] is None and ev["rmse_log"] == 0.5 and ev["n"] == 2


def test_training_layout_follows_from_the_rows(spark, monkeypatch):
    import paysight.plans.gold as gold_mod

    monkeypatch.setattr(gold_mod, "ROWS_PER_PARTITION", 20)
    g, _ = gold_mod.gold(_survey_like(spark))
    layouts = []
    for parts in (1, 5):
        train_df, _ = gold_mod.training_rows(g.repartition(parts), False, 0.0, 80, True)
        layouts.append([tuple(r) for r in train_df.withColumn("p", F.spark_partition_id()).select("p", "ResponseId", "label").collect()])
    assert layouts[0] == layouts[1] and len({r[0] for r in layouts[0]}) > 1


def test_training_partitions_spread_small_tables_and_stay_few():
    from paysight.plans.gold import partitions_for

    assert partitions_for(0) == partitions_for(19_999) == 1
    assert partitions_for(192_000) == 10  # two before
    # each hands on the sums of all nodes at every level of every tree
    assert partitions_for(1_920_000) == partitions_for(11_500_000) == 24
    assert partitions_for(50_000_000) == 101  # none grows with the table
