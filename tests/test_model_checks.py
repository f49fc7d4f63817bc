"""The checks of fitted models hold for a right fit and fail for a wrong one."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from paysight.operators import slots as S
from paysight.operators import trees as T
from paysight.operators.features import FeatureSpec, fit_features
from paysight.operators.models import LR_V1, LR_V2, score, train_lr
from paysight.operators.text import fill_text
from paysight.sources.models import save_model


@pytest.fixture(scope="module")
def data(spark):
    cols = [((F.xxhash64("id", F.lit(k)) % 1000) / 500).alias(f"x{k}") for k in range(6)]
    df = spark.range(3000).select(F.col("id"), *cols, (F.col("id") % 3 == 0).cast("double").alias("x6"))
    noise = (F.xxhash64("id", F.lit(99)) % 1000) / 2000
    df = df.withColumn("label", 2 * F.col("x0") - F.col("x1") * F.col("x2") + 0.3 * F.col("x6") + noise)
    return VectorAssembler(inputCols=[f"x{k}" for k in range(7)], outputCol="features").transform(df).repartition(3).persist()


@pytest.fixture(scope="module")
def boosted(spark, data, tmp_path_factory):
    model = GBTRegressor(maxIter=8, maxDepth=4, stepSize=0.1, subsamplingRate=0.8, seed=5).fit(data)
    path = str(tmp_path_factory.mktemp("gbt") / "m")
    save_model(model, path)
    return model, T.tree_nodes(spark, path)


def test_routes_give_the_predictions(data, boosted):
    model, nodes = boosted
    both = model.transform(T.route(data, nodes, depth=4)).withColumn("own", T.boosted_prediction(F.col("parts")))
    assert both.filter(F.abs(F.col("own") - F.col("prediction")) > 1e-9).count() == 0
    # leaves are MLlib's own
    leaf = both.select(F.max(F.size("parts"))).first()[0]
    assert leaf == 8


def test_rows_are_routed_in_blocks_of_a_bounded_size(boosted, monkeypatch):
    """The same leaves whatever the blocks, and features gathered from one block at a time."""
    _, nodes = boosted
    forest = T.Forest(nodes)
    x = np.random.default_rng(1).random((50, 7))
    whole = forest.leaves(x, 4)
    sizes, plain = [], T.np.ascontiguousarray
    monkeypatch.setattr(T, "BLOCK", 8)
    monkeypatch.setattr(T.np, "ascontiguousarray", lambda part: sizes.append(len(part)) or plain(part))
    assert np.array_equal(forest.leaves(x, 4), whole) and max(sizes) == 8 and sum(sizes) == 50


def test_leaf_values_follow_from_the_rows(data, boosted):
    _, nodes = boosted
    r = T.audit_holds(T.leaf_audit(data, nodes, depth=4)).first()
    assert r.leaves_follow and 0.3 < r.mean_z2 < 4 and r.leaves == nodes.filter("left = -1").count()


@pytest.mark.parametrize("wrong", ["value", "weight", "rows"])
def test_wrong_trees_are_found(data, boosted, wrong):
    _, nodes = boosted
    rows = data
    if wrong == "value":  # one leaf off by a tenth
        leaf = nodes.filter("left = -1 AND tree = 3").orderBy(F.desc("n_fitted")).first()
        nodes = nodes.withColumn("value", F.when((F.col("tree") == 3) & (F.col("node") == leaf.node), F.col("value") + 1).otherwise(F.col("value")))
    elif wrong == "weight":  # other residuals for all later trees
        nodes = nodes.withColumn("weight", F.when(F.col("tree") > 0, 0.5).otherwise(F.col("weight")))
    else:
        rows = data.withColumn("label", F.col("label") + F.col("x3"))
    assert not T.audit_holds(T.leaf_audit(rows, nodes, depth=4)).first().leaves_follow


def test_checks_hand_on_sums_per_leaf_not_rows_per_tree(data, boosted):
    """What a check of the trees costs beside a row's routing does not grow with rows times trees, and no tree is walked in an expression."""
    _, nodes = boosted
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    audit = plan(T.leaf_audit(data, nodes, depth=4))
    assert "Generate" not in audit and "lambda" not in audit
    assert "lambda" not in plan(T.route(data, nodes, depth=4))


def test_rows_without_features_go_right(spark, boosted):
    """As a null or missing number compares: neither is at most a threshold."""
    _, nodes = boosted
    df = spark.createDataFrame([(1, [float("nan")] * 7), (2, None)], "id long, x array<double>")
    forest = T.Forest(nodes)
    right = []
    for at in forest.first:
        while forest.right[at] != at:
            at = forest.right[at]
        right.append(forest.node[at])
    for row in df.collect():
        import pyarrow as pa

        x = T._matrix(pa.array([row.x, [0.0] * 7], pa.list_(pa.float64())))
        assert forest.node[forest.leaves(x, 4)[:, 0]].tolist() == right


def test_categorical_splits_route_alike(spark, tmp_path):
    from pyspark.ml.feature import VectorIndexer

    df = spark.range(600).select(((F.col("id") * 7) % 5).cast("double").alias("c"), (F.xxhash64("id") % 100 / 9).alias("x"))
    df = VectorAssembler(inputCols=["c", "x"], outputCol="raw").transform(df.withColumn("label", F.when(F.col("c").isin(1, 4), 3.0).otherwise(1.0) + F.col("x") / 50))
    df = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=5).fit(df).transform(df)
    model = GBTRegressor(maxIter=3, maxDepth=3, seed=1).fit(df)
    save_model(model, str(tmp_path / "m"))
    nodes = T.tree_nodes(spark, str(tmp_path / "m"))
    assert nodes.filter("categories > 0").count() > 0
    both = model.transform(T.route(df, nodes, depth=3)).withColumn("own", T.boosted_prediction(F.col("parts")))
    assert both.filter(F.abs(F.col("own") - F.col("prediction")) > 1e-9).count() == 0


def worst(data, model, params, tmp_path):
    path = str(tmp_path / "lr")
    save_model(model, path)
    weights = S.saved_weights(data.sparkSession, path)
    return S.linear_conditions(model.transform(data), weights, params).agg(F.max("excess")).first()[0]


@pytest.mark.parametrize("params", [LR_V1, LR_V2])
def test_linear_fits_meet_their_conditions(data, tmp_path, params):
    assert worst(data, train_lr(data, params), params, tmp_path) < 1e-5


@pytest.mark.parametrize("change", [{"regParam": 0.02}, {"elasticNetParam": 0.9}, {"maxIter": 1}])
def test_other_linear_fits_do_not(data, tmp_path, change):
    other = {**LR_V2, **change}
    if "maxIter" in change:
        other["solver"] = "l-bfgs"
    assert worst(data, train_lr(data, other), LR_V2, tmp_path) > 1e-3


def test_long_form_scores_equal_the_vector_path(spark, tmp_path):
    rows = [(k, ["A", "B", None, "C"][k % 4], ["x;Y", "", None, "y;z;y"][(k // 4) % 4], float(k % 9), 1000.0 + 37 * (k % 9) + 90 * (k % 4)) for k in range(160)]
    df = spark.createDataFrame(rows, "ResponseId long, CountryGrouped string, LanguageHaveWorkedWith string, YearsCodeProNum_imp double, pay double")
    filled = fill_text(df, ["LanguageHaveWorkedWith"], empty_too=True)
    pipe = fit_features(filled, FeatureSpec.resolve(filled))
    model = train_lr(pipe.transform(filled).withColumn("label", F.log1p("pay")), LR_V1)
    save_model(model, str(tmp_path / "lr"))
    requests = df.unionByName(spark.createDataFrame([(900, "new", "q;x", 3.0, 0.0), (901, None, None, 0.0, 0.0)], df.schema))
    slots = S.feature_slots(spark, pipe)
    long = S.long_features(fill_text(requests, ["LanguageHaveWorkedWith"], empty_too=True), slots, ["ResponseId"])
    got = {r.ResponseId: (r.pred_log, r.salary_pred) for r in S.linear_scores(long, S.saved_weights(spark, str(tmp_path / "lr")), ["ResponseId"]).collect()}
    want = score(requests, pipe, model, ["LanguageHaveWorkedWith"]).collect()
    assert len(got) == len(want) == 162
    for r in want:
        assert got[r.ResponseId] == pytest.approx((r.pred_log, r.salary_pred), rel=1e-9)


def test_linear_scores_read_the_features_once(spark, data, tmp_path):
    """One scan of the rows: the intercept does not come from a second pass over their keys."""
    weights = spark.createDataFrame([(0, 2.0), (-1, 0.5)], "slot int, weight double")
    rows = spark.createDataFrame([(1, 0, 3.0), (1, 5, 9.0), (2, 5, 1.0)], "id long, slot int, value double")
    got = S.linear_scores(rows, weights, ["id"])
    assert {r.id: r.pred_log for r in got.collect()} == {1: 6.5, 2: 0.5}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Union") == 0
