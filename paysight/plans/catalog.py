"""Query catalogue: one Spark query per operator, all over whole tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame. The
matching DuckDB text is in :mod:`paysight.plans.oracle` under the same name.
Computed doubles are rounded to 6 places on both sides; exact quantiles
(``rel_error=0``) are used wherever a result is checked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paysight.functions.parse import age_to_double, years_to_double
from paysight.operators import profile as prof
from paysight.operators.features import assemble_and_scale, vocabulary
from paysight.operators.filters import at_most, drop_any_null, population_filter, positive
from paysight.operators.models import (
    LR_V1,
    LR_V2,
    best_model,
    diagnostics,
    evaluate,
    score,
    train_lr,
    with_label,
)
from paysight.operators.quantiles import quantile_values
from paysight.operators.rare import group_rare
from paysight.operators.sample import hash_sample, hash_split, with_split
from paysight.operators.text import fill_text, join_choices, split_tokens
from paysight.operators.trim import impute_median, trim_quantiles
from paysight.operators.union import union_by_name
from paysight.plans.eda import eda, long_charts, report
from paysight.plans.gold import gold, train, train_gbt_only
from paysight.plans.silver import SilverParams, silver
from paysight.schema import TARGET, safe_double, select_available, select_strict
from paysight.sources.tables import load_table, survey_view

EXACT = 0.0
# Parameters of the checked queries (sf0.01 facts: country groups after the
# population filter hold 117-222 rows, so 160 exercises both branches).
RARE_MIN = 160
QUARTILE_DIMS = [("RemoteWork", 10, 300), ("EdLevel", 12, 300), ("OrgSize", 12, 300)]
SAMPLE_N = 5000
# Distance from the elastic net's conditions, in units of a correlation, that a converged fit may have.
CONDITION_TOLERANCE = 1e-4


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _survey(spark: SparkSession, sf: str) -> DataFrame:
    return survey_view(spark, sf)


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return load_table(spark, sf, "orders")


def _lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return load_table(spark, sf, "lineitem")


# ---------------------------------------------------------------- sources


def q_survey_base(spark, sf):
    return _survey(spark, sf)


def _order_batches(spark, sf, drop_priority_in_mid: bool) -> list[DataFrame]:
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    day = F.col("o_orderdate")
    start, stop = F.lit("1997-01-01").cast("date"), F.lit("1999-01-01").cast("date")
    # plain ranges reach the scan; a row without a date belongs to the last batch
    parts = [("early", day < start), ("mid", (day >= start) & (day < stop)), ("late", (day >= stop) | day.isNull())]
    frames = []
    for tag, cond in parts:
        f = o.where(cond).withColumn("batch", F.lit(tag))
        if drop_priority_in_mid and tag == "mid":
            f = f.drop("o_orderpriority")
        frames.append(f)
    return frames


def q_union_strict(spark, sf):
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "batch"]
    return union_by_name([select_strict(f, columns) for f in _order_batches(spark, sf, False)], allow_missing=False)


def q_union_null_fill(spark, sf):
    return union_by_name(_order_batches(spark, sf, True), allow_missing=True)


# ---------------------------------------------------------------- projections


def q_tolerant_select(spark, sf):
    return select_available(_survey(spark, sf), ["ResponseId", "Country", "YearsCode", "Age", "Currency", "EdLevel"])


def q_safe_cast(spark, sf):
    s = _survey(spark, sf)
    return s.select("ResponseId", "YearsCodePro", safe_double("YearsCodePro").alias("YearsCodePro_double"))


# ---------------------------------------------------------------- filters


def q_pop_filter(spark, sf):
    return population_filter(_survey(spark, sf)).select("ResponseId", "Country", TARGET)


def q_positive_filter(spark, sf):
    return positive(_survey(spark, sf), TARGET).select("ResponseId", TARGET)


def q_trim_outliers(spark, sf):
    pop = population_filter(_survey(spark, sf))
    return trim_quantiles(pop, TARGET, 0.01, 0.99, EXACT).select("ResponseId", TARGET)


def q_upper_cut(spark, sf):
    o = _orders(spark, sf)
    (q99,) = quantile_values(o, "o_totalprice", [0.99], EXACT)
    return at_most(o, "o_totalprice", q99).select("o_orderkey", "o_totalprice")


def q_drop_any_null(spark, sf):
    s = _survey(spark, sf).select("ResponseId", "YearsCodePro", "Age", "RemoteWork")
    return drop_any_null(s, ["YearsCodePro", "Age", "RemoteWork"])


# ---------------------------------------------------------------- parsers


def q_parse_years(spark, sf):
    s = _survey(spark, sf)
    return s.select("ResponseId", "YearsCodePro", years_to_double("YearsCodePro").alias("YearsCodeProNum"))


def q_parse_age(spark, sf):
    s = _survey(spark, sf)
    return s.select("ResponseId", "Age", age_to_double("Age").alias("AgeNum"))


# ---------------------------------------------------------------- silver


def q_group_rare(spark, sf):
    pop = population_filter(_survey(spark, sf))
    return group_rare(pop, "Country", RARE_MIN).select("ResponseId", "Country", "CountryGrouped")


def q_impute_median(spark, sf):
    s = _survey(spark, sf).select(
        "ResponseId", years_to_double("YearsCodePro").alias("YearsCodeProNum"), age_to_double("Age").alias("AgeNum")
    )
    return impute_median(s, ["YearsCodeProNum", "AgeNum"], EXACT)


def q_fill_text(spark, sf):
    s = _survey(spark, sf).select("ResponseId", "LanguageHaveWorkedWith", "DatabaseHaveWorkedWith")
    return fill_text(s)


SILVER_COLUMNS = [
    "ResponseId",
    "SurveyYear",
    TARGET,
    "CompTotal",
    "Country",
    "CountryGrouped",
    "MainBranch",
    "Employment",
    "DevType",
    "YearsCodePro",
    "YearsCodeProNum",
    "YearsCodeProNum_imp",
    "Age",
    "AgeNum",
    "AgeNum_imp",
    "EdLevel",
    "OrgSize",
    "RemoteWork",
    "LanguageHaveWorkedWith",
    "DatabaseHaveWorkedWith",
]


def silver_frame(spark, sf):
    return silver(_survey(spark, sf), SilverParams(rel_error=EXACT, min_country=RARE_MIN))


def q_silver_full(spark, sf):
    return silver_frame(spark, sf).select(*SILVER_COLUMNS)


# ---------------------------------------------------------------- profiles


def q_profile_year(spark, sf):
    p = prof.profile(_survey(spark, sf), TARGET, by=["SurveyYear"], rel_error=EXACT)
    return p.withColumn("mean_salary", r6("mean_salary"))


def q_profile_table(spark, sf):
    p = prof.profile(_survey(spark, sf), TARGET, rel_error=EXACT)
    return p.withColumn("mean_salary", r6("mean_salary"))


def q_missing_rates(spark, sf):
    usable = positive(_survey(spark, sf), TARGET)
    return prof.missingness(usable, 20).withColumn("missing_pct", r6("missing_pct"))


def q_group_quartiles(spark, sf):
    usable = positive(_survey(spark, sf), TARGET)
    return prof.quartiles_by_dimension(usable, QUARTILE_DIMS, TARGET, EXACT)


def q_top_groups(spark, sf):
    return prof.top_k(positive(_survey(spark, sf), TARGET), "Country", 15)


def q_salary_trend(spark, sf):
    return prof.trend(positive(_survey(spark, sf), TARGET), TARGET, "SurveyYear", EXACT)


def q_salary_quantiles(spark, sf):
    from paysight.operators.quantiles import exact_quantiles

    return exact_quantiles(_lineitem(spark, sf), "l_extendedprice", [0.01, 0.5, 0.99], names=["q01", "median", "q99"])


def _hist_rows(spark, sf):
    o = _orders(spark, sf)
    (q99,) = quantile_values(o, "o_totalprice", [0.99], EXACT)
    kept = at_most(positive(o, "o_totalprice"), "o_totalprice", q99)
    return kept.withColumn("log_price", F.log1p("o_totalprice"))


def _rounded_hist(h: DataFrame) -> DataFrame:
    return h.select("bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "n")


def q_hist_raw(spark, sf):
    return _rounded_hist(prof.histogram(_hist_rows(spark, sf), "o_totalprice", 60))


def q_hist_log(spark, sf):
    return _rounded_hist(prof.histogram(_hist_rows(spark, sf), "log_price", 60))


CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def q_corr_matrix(spark, sf):
    return prof.corr_long(_lineitem(spark, sf), CORR_COLS).withColumn("corr", r6("corr"))


def q_hash_sample(spark, sf):
    return hash_sample(_orders(spark, sf).select("o_orderkey", "o_totalprice"), "o_orderkey", SAMPLE_N)


def q_hash_split(spark, sf):
    return with_split(_orders(spark, sf).select("o_orderkey"), "o_orderkey", 80)


# ---------------------------------------------------------------- features


def q_index_labels(spark, sf):
    from pyspark.ml.feature import StringIndexer

    s = _survey(spark, sf).select("ResponseId", "Country", "OrgSize")
    m = StringIndexer(
        inputCols=["Country", "OrgSize"], outputCols=["Country_idx", "OrgSize_idx"], handleInvalid="keep"
    ).fit(s)
    return m.transform(s)


def q_one_hot(spark, sf):
    from paysight.operators.features import index_and_encode

    enc = index_and_encode(_survey(spark, sf).select("ResponseId", "OrgSize"), "OrgSize")
    arr = vector_to_array("OrgSize_vec")
    return enc.select(
        "ResponseId",
        "OrgSize",
        F.size(arr).alias("vec_size"),
        (F.array_position(arr, F.lit(1.0)) - 1).cast("int").alias("hot_slot"),
        F.aggregate(arr, F.lit(0.0), lambda a, b: a + b).alias("vec_sum"),
    )


def q_tokens(spark, sf):
    s = fill_text(_survey(spark, sf).select("ResponseId", "LanguageHaveWorkedWith", "DatabaseHaveWorkedWith"))
    lang, db = split_tokens("LanguageHaveWorkedWith"), split_tokens("DatabaseHaveWorkedWith")
    return s.select(
        "ResponseId",
        join_choices(lang, "|").alias("lang_tokens"),
        F.size(lang).alias("n_lang"),
        join_choices(db, "|").alias("db_tokens"),
        F.size(db).alias("n_db"),
    )


def q_token_counts(spark, sf):
    s = fill_text(_survey(spark, sf))
    v = vocabulary(s, ["LanguageHaveWorkedWith", "DatabaseHaveWorkedWith"], 30, 0.01)
    return v.select(F.col("column").alias("field"), "token", "tf", "df", F.col("rank").cast("int").alias("rank"))


def q_assemble_scale(spark, sf):
    li = _lineitem(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    scaled = assemble_and_scale(li, ["l_quantity", "l_extendedprice", "l_discount"])
    arr = vector_to_array("features")
    return scaled.select(
        "l_orderkey", "l_linenumber", r6(arr[0]).alias("f0"), r6(arr[1]).alias("f1"), r6(arr[2]).alias("f2")
    )


def q_features_gold(spark, sf):
    """Every non-zero slot of every gold vector, from a gold table that was written and read again."""
    import uuid

    from paysight.runtime import scratch_root
    from paysight.sources.files import write_table

    g, _ = gold(silver_frame(spark, sf))
    path = f"{scratch_root(spark).rstrip('/')}/paysight-gold/{uuid.uuid4().hex}"
    write_table(g, path, partitions=8)
    slots = spark.read.parquet(path).select("SurveyYear", "ResponseId", F.posexplode(vector_to_array("features")).alias("slot", "value"))
    return slots.where(F.col("value") != 0).select("SurveyYear", "ResponseId", "slot", r6("value").alias("value"))


# ---------------------------------------------------------------- models


def _lr_1f_data(spark, sf):
    from pyspark.ml.feature import VectorAssembler

    li = _lineitem(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    li = with_label(li, "l_extendedprice")
    return VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(li)


def _lr_coef(spark, sf, params):
    m = train_lr(_lr_1f_data(spark, sf), params)
    # a fitted model is two numbers; they are returned as a one-row table
    return spark.createDataFrame(
        [(float(m.intercept), float(m.coefficients[0]))], "intercept double, slope double"
    ).select(r6("intercept").alias("intercept"), r6("slope").alias("slope"))


def q_lr_ridge_1f(spark, sf):
    return _lr_coef(spark, sf, LR_V1)


def q_lr_enet_1f(spark, sf):
    return _lr_coef(spark, sf, LR_V2)


def _split_predictions(spark, sf, params):
    data = _lr_1f_data(spark, sf)
    train_df, test_df = hash_split(data, "l_orderkey", 80)
    m = train_lr(train_df, params)
    return m.transform(test_df)


def _rounded_metrics(ev: DataFrame) -> DataFrame:
    return ev.select(
        "n",
        r6("rmse_log").alias("rmse_log"),
        r6("r2_log").alias("r2_log"),
        F.round("mae", 2).alias("mae"),
        F.round("rmse", 2).alias("rmse"),
        "n_infinite",
    )


def q_metrics_from_predictions(spark, sf):
    return _rounded_metrics(evaluate(_split_predictions(spark, sf, LR_V1)))


def q_best_model(spark, sf):
    rows = []
    for name, params in (("lr_ridge", LR_V1), ("lr_enet", LR_V2)):
        ev = evaluate(_split_predictions(spark, sf, params)).withColumn("model", F.lit(name))
        rows.append(ev)
    best = best_model(union_by_name(rows), "model", "rmse_log")
    return best.select("model", r6("rmse_log").alias("rmse_log"))


def q_diagnostics_lr(spark, sf):
    pred = _split_predictions(spark, sf, LR_V1)
    pred = pred.withColumn("key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    d = diagnostics(pred, "key", rel_error=EXACT)
    return _rounded_hist(d["residual_hist"])


def _checked(train_df: DataFrame, test_df: DataFrame, name: str, model) -> DataFrame:
    """What a fitted model can be held to exactly: its test rows and their labels, and whether
    every prediction is finite and the training error below that of predicting the mean."""
    finite = lambda c: F.abs(F.col(c)) < F.lit(float("inf"))
    both = train_df.withColumn("trains", F.lit(True)).unionByName(test_df.withColumn("trains", F.lit(False)))
    test, err = F.when(~F.col("trains"), F.col("label")), F.col("label") - F.col("prediction")
    return model.transform(both).agg(
        F.lit(name).alias("model"),
        F.count(test).alias("n"),
        r6(F.avg(test)).alias("label_mean"),
        r6(F.stddev_samp(test)).alias("label_std"),
        F.every(finite("prediction")).alias("all_finite"),
        (F.avg(F.when(F.col("trains"), err * err)) < F.var_pop(F.when(F.col("trains"), F.col("label")))).alias("beats_mean"),
    )


def _models_folder(spark) -> str:
    import uuid

    from paysight.runtime import scratch_root

    return f"{scratch_root(spark).rstrip('/')}/paysight-models/{uuid.uuid4().hex}"


def _audited(train_df: DataFrame, test_df: DataFrame, name: str, model, params: dict) -> DataFrame:
    """:func:`_checked`, and whether the saved fit follows from its training rows (``follows``: the elastic net's conditions
    in every slot, or the values of all leaves), whether every test prediction equals that of a second path from the saved
    tables (``agrees``), and whether the metrics of both paths are the same (``metrics_agree``)."""
    from paysight.operators import slots, trees
    from paysight.runtime import stage_table
    from paysight.sources.models import save_model

    spark, keys = train_df.sparkSession, ["SurveyYear", "ResponseId"]
    path = f"{_models_folder(spark)}/{name}"
    save_model(model, path)
    if name.startswith("lr"):
        weights = slots.saved_weights(spark, path)
        follows = slots.linear_conditions(model.transform(train_df), weights, params).agg((F.max("excess") < CONDITION_TOLERANCE).alias("follows"))
        own = slots.linear_scores(slots.vector_slots(test_df, keys), weights, keys).select(*keys, F.col("pred_log").alias("own"))
    else:
        nodes = trees.tree_nodes(spark, path)
        follows = trees.audit_holds(trees.leaf_audit(train_df, nodes, depth=params["maxDepth"])).select(F.col("leaves_follow").alias("follows"))
        own = trees.route(test_df.select(*keys, "features"), nodes, depth=params["maxDepth"]).select(*keys, trees.boosted_prediction(F.col("parts")).alias("own"))
    both = stage_table(model.transform(test_df).select(*keys, "label", "prediction").join(own, keys, "left"), "audit")
    agrees = both.agg(F.every(F.coalesce(F.abs(F.col("own") - F.col("prediction")) <= 1e-8, F.lit(False))).alias("agrees"))
    a, b = evaluate(both), evaluate(both, prediction="own")
    close = [F.abs(a[c] - b[c]) <= 1e-6 * (1 + F.abs(a[c])) for c in ("rmse_log", "r2_log", "mae", "rmse")]
    # every frame here has one row
    same = a.join(F.broadcast(b)).select(((a["n"] == b["n"]) & (a["n_infinite"] == b["n_infinite"]) & close[0] & close[1] & close[2] & close[3]).alias("metrics_agree"))
    return _checked(train_df, test_df, name, model).join(F.broadcast(follows)).join(F.broadcast(agrees)).join(F.broadcast(same))


def q_train_lr_full(spark, sf):
    """Both linear settings on the gold features (L1, L2, L6, L7): v1 on all
    labelled rows, v2 after the exact 1-99 % trim; same hash split."""
    from paysight.plans.gold import SETTINGS, training_rows
    from paysight.runtime import stage_table

    g = stage_table(gold(silver_frame(spark, sf))[0], "gold")
    rows = []
    for version in ("v1", "v2"):
        lr_params, _, trim = SETTINGS[version]
        train_df, test_df = training_rows(g, trim, EXACT, 80, False)
        rows.append(_audited(train_df, test_df, f"lr_{version}", train_lr(train_df, lr_params), lr_params))
    return union_by_name(rows)


def _train_full(spark, sf, version):
    """Both models of a version at their full settings, from the library's own training stage."""
    from paysight.plans.gold import SETTINGS
    from paysight.runtime import stage_table

    # read by the fits and by every check of them
    g = stage_table(gold(silver_frame(spark, sf))[0], "gold")
    result = train(g, version, rel_error=EXACT)
    params = dict(zip(result.models, SETTINGS[version]))
    return union_by_name([_audited(result.train_rows, result.test_rows, name, model, params[name]) for name, model in result.models.items()])


def q_train_v1(spark, sf):
    return _train_full(spark, sf, "v1")


def q_train_v2(spark, sf):
    return _train_full(spark, sf, "v2")


REQUEST_COLUMNS = [
    "SurveyYear",
    "ResponseId",
    "YearsCodeProNum_imp",
    "CountryGrouped",
    "EdLevel",
    "RemoteWork",
    "OrgSize",
    "LanguageHaveWorkedWith",
    "DatabaseHaveWorkedWith",
]


# Request columns beside the two that `jobs_score` groups by.
REQUEST_FIELDS = ["YearsCodeProNum_imp", "CountryGrouped", "OrgSize", "LanguageHaveWorkedWith", "DatabaseHaveWorkedWith"]


def _requests(silver_df: DataFrame) -> DataFrame:
    return positive(silver_df, TARGET).select(*REQUEST_COLUMNS)


def q_batch_score(spark, sf):
    """Every silver row as a request, scored by a pipeline and models that were saved and read again (S10, S11, L9, P7), and
    whether a second path gives the same log and money predictions: for the linear model the plain columns joined with
    slot and weight tables, for the trees the saved nodes."""
    from paysight.operators import slots, trees
    from paysight.operators.models import GBT_V1
    from paysight.plans.gold import training_rows
    from paysight.runtime import stage_table
    from paysight.sources.models import load_pipeline, load_regressor, save_model

    silver_df, keys = silver_frame(spark, sf), ["SurveyYear", "ResponseId"]
    g, pipe = gold(silver_df)
    g = stage_table(g, "gold")  # read by both fits
    run = _models_folder(spark)
    save_model(pipe, f"{run}/pipeline")
    save_model(train_lr(training_rows(g, False, EXACT, 80, False)[0], LR_V1), f"{run}/lr_v1")
    save_model(train_gbt_only(g, "v1"), f"{run}/gbt_v1")
    requests, saved = _requests(silver_df), load_pipeline(f"{run}/pipeline")
    models = {kind: load_regressor(f"{run}/{kind}_v1", kind) for kind in ("lr", "gbt")}
    columns = [f"{kind}_{c}" for kind in models for c in ("pred_log", "salary_pred")]
    # read by both comparisons and by the routing of the same features
    scored = stage_table(score(requests, saved, models).select(*keys, "features", *columns), "scored")
    long = slots.long_features(fill_text(requests, empty_too=True), slots.feature_slots(spark, saved), keys)
    own_lr = slots.linear_scores(long, slots.saved_weights(spark, f"{run}/lr_v1"), keys)
    routed = trees.route(scored.select(*keys, "features"), trees.tree_nodes(spark, f"{run}/gbt_v1"), depth=GBT_V1["maxDepth"])
    own_gbt = routed.select(*keys, trees.boosted_prediction(F.col("parts")).alias("pred_log")).withColumn("salary_pred", F.expm1("pred_log"))
    out = requests.select(*keys)
    for name, b in (("lr", own_lr), ("gbt", own_gbt)):
        a = scored.select(*keys, F.col(f"{name}_pred_log").alias("p"), F.col(f"{name}_salary_pred").alias("s"))
        b = b.select(*keys, F.col("pred_log").alias("q"), F.col("salary_pred").alias("t"))
        close = lambda x, y: F.coalesce(F.abs(F.col(x) - F.col(y)) <= 1e-8 * (1 + F.abs(x)), F.lit(False))
        out = out.join(a.join(b, keys, "left").select(*keys, close("p", "q").alias(f"{name}_pred_log"), close("s", "t").alias(f"{name}_salary_pred")), keys, "left")
    return out


def q_score_features(spark, sf):
    """Features made for scoring against the gold features of the same rows: (rows, rows that differ)."""
    from paysight.operators.text import fill_text as fill

    silver_df = silver_frame(spark, sf)
    g, pipe = gold(silver_df)
    keys = ["SurveyYear", "ResponseId"]
    ours = pipe.transform(fill(_requests(silver_df), empty_too=True)).select(*keys, vector_to_array("features").alias("a"))
    both = ours.join(g.select(*keys, vector_to_array("features").alias("b")), keys, "full")
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("n_differ"))


def q_scatter_bins(spark, sf):
    """All rows of a scatter chart by cell."""
    cells = prof.scatter_bins(_lineitem(spark, sf), "l_quantity", "l_extendedprice", 40)
    return cells.select("x_bin", "y_bin", r6("x_lo").alias("x_lo"), r6("y_lo").alias("y_lo"), "n")


def q_hash_split_keys(spark, sf):
    """A split by two keys, one of them null in part and repeated: every row on one side (T5)."""
    keys = _orders(spark, sf).select(F.col("o_orderkey"), F.nullif(F.col("o_orderkey") % 97, F.lit(0)).alias("k"), F.col("o_orderstatus"))
    train_rows, test_rows = hash_split(keys, ["k", "o_orderstatus"], 80)
    return train_rows.withColumn("split", F.lit("train")).unionByName(test_rows.withColumn("split", F.lit("test")))


def q_bronze_two_years(spark, sf):
    """Two years landed by two calls into one bronze table, read back with a year filter."""
    import uuid

    from paysight.runtime import scratch_root
    from paysight.sources.files import read_bronze, write_bronze

    path = f"{scratch_root(spark).rstrip('/')}/paysight-bronze/{uuid.uuid4().hex}"
    survey = _survey(spark, sf)
    for year in (1996, 1997):
        write_bronze(survey.where(F.col("SurveyYear") == year), path)
    return read_bronze(spark, path, [1996, 1997]).select(*survey.columns)


def q_stream_landing(spark, sf):
    """Survey rows written as year-partitioned CSV files, landed by the file
    stream into bronze, read back (S1, S8, streaming landing)."""
    import uuid

    from paysight.runtime import scratch_root
    from paysight.streaming.landing import BATCH_COL, land_stream

    run = f"{scratch_root(spark).rstrip('/')}/paysight-landing-run/{uuid.uuid4().hex}"
    survey = _survey(spark, sf)
    # a marker of its own for nulls, so that empty texts come back as they are
    survey.write.partitionBy("SurveyYear").option("header", True).option("nullValue", "\\N").csv(f"{run}/inbox")
    land_stream(spark, f"{run}/inbox", f"{run}/bronze", f"{run}/checkpoint", year_pattern=r"SurveyYear=(\d{4})", null_value="\\N")
    return spark.read.parquet(f"{run}/bronze").drop(BATCH_COL)


def q_index_many(spark, sf):
    """A column of very many labels indexed by ranks from a range-partitioned sort (M1)."""
    from paysight.operators.label_index import index_column, label_ranks

    items = _lineitem(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey")
    return index_column(items, "l_partkey", label_ranks(items, "l_partkey"))


# Texts that make a CSV file hard to cut: lines and quotes inside quoted fields.
CSV_NOTE = "CASE WHEN ResponseId % 3 = 0 THEN Country || '\"' || chr(10) || coalesce(EdLevel, '') || chr(10) || chr(10) || '\",\"' WHEN ResponseId % 3 = 1 THEN Country END"


def q_csv_splits(spark, sf):
    """Survey rows written as CSV with line ends and quotes inside fields, read in byte ranges far smaller than a file."""
    from paysight.sources.csv_splits import read_csv_splits

    rows = _survey(spark, sf).select("ResponseId", F.expr(CSV_NOTE).alias("note"), "Age", "EdLevel")
    path = f"{_models_folder(spark)}-csv"
    rows.write.option("header", True).option("escape", '"').option("nullValue", "\\N").csv(path)
    got = read_csv_splits(spark, path, split_bytes=100_000, null_value="\\N")
    return got.withColumn("ResponseId", F.col("ResponseId").cast("long"))


def _landed_twice(spark, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The merged state and the bronze rows of two landings that share their years."""
    from paysight.operators.rolling import land_state, merged_state
    from paysight.sources.files import read_bronze, write_bronze

    path = _models_folder(spark)
    for batch, part in (("first", rows.where("ResponseId % 3 = 0")), ("second", rows.where("ResponseId % 3 <> 0"))):
        write_bronze(part, f"{path}-bronze", mode="append")
        land_state(part, f"{path}-state", batch)
    return merged_state(spark, f"{path}-state"), read_bronze(spark, f"{path}-bronze")


def q_profile_growing(spark, sf):
    """The year profile from counts kept over two landings."""
    from paysight.operators.rolling import profile_from_state

    state, rows = _landed_twice(spark, _survey(spark, sf))
    return profile_from_state(state, rows).withColumn("mean_salary", r6("mean_salary"))


def q_trend_growing(spark, sf):
    """The salary trend from counts kept over two landings."""
    from paysight.operators.rolling import trend_from_state

    state, rows = _landed_twice(spark, positive(_survey(spark, sf), TARGET))
    return trend_from_state(state, rows)


def q_diagnostics_scatter(spark, sf):
    """Actual against predicted by cell, on the log scale and, clipped, on the money scale."""
    pred = _split_predictions(spark, sf, LR_V1).withColumn("key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    d = diagnostics(pred, "key", rel_error=EXACT)
    cells = [d[name].select(F.lit(name).alias("chart"), "x_bin", "y_bin", r6("x_lo").alias("x_lo"), r6("y_lo").alias("y_lo"), "n") for name in ("scatter_log", "scatter_real")]
    return union_by_name(cells)


def q_run_report(spark, sf):
    return report(silver_frame(spark, sf), EXACT)


def q_eda_charts(spark, sf):
    """Every chart's table of the EDA stage on the silver rows, in one long form."""
    return long_charts(eda(silver_frame(spark, sf), EXACT)).withColumn("value", r6("value"))


def q_jobs_silver(spark, sf):
    """Yearly CSV files landed by the bronze job in byte ranges and taken to silver by the silver job, which keeps its fit;
    the saved fit over the bronze rows gives the same table, and that is what is returned (S2, S3, S4, S5, S13, P1)."""
    from paysight.plans import jobs
    from paysight.plans.silver import SilverModel
    from paysight.schema import require_columns
    from paysight.sources.files import read_bronze

    run, survey = _models_folder(spark), _survey(spark, sf)
    survey.write.partitionBy("SurveyYear").option("header", True).option("escape", '"').option("nullValue", "\\N").csv(f"{run}/raw")
    years = [r[0] for r in survey.select("SurveyYear").distinct().collect()]  # as many as there are yearly files
    jobs.bronze(spark, {y: f"{run}/raw/SurveyYear={y}" for y in years}, f"{run}/bronze", null_value="\\N", split_bytes=1 << 22)
    params = SilverParams(rel_error=EXACT, min_country=RARE_MIN)
    written = jobs.silver_job(spark, f"{run}/bronze", f"{run}/silver", params, f"{run}/silver-model")
    replayed = SilverModel.load(spark, f"{run}/silver-model").transform(read_bronze(spark, f"{run}/bronze"))
    first, second = (select_strict(require_columns(df, [TARGET, "ResponseId"]), SILVER_COLUMNS) for df in (written, replayed))
    both = first.withColumn("by_job", F.lit(1)).unionByName(second.withColumn("by_job", F.lit(-1)))
    # one row for each that both tables have as often; a row that only one has comes out with another count
    same = both.groupBy(*SILVER_COLUMNS).agg(F.sum("by_job").alias("surplus"))
    return same.withColumn("ResponseId", F.col("ResponseId").cast("long"))


def q_jobs_score(spark, sf):
    """Requests as Python mappings, one for each education level and work mode, scored by the score job with the saved
    pipeline and model of the gold job's table; ``agrees``: plain columns joined with the saved slot weights give the
    same log and money predictions (S6, S7, S10, S11, L9, P7)."""
    from paysight.operators import slots
    from paysight.plans import jobs
    from paysight.plans.gold import training_rows
    from paysight.sources.files import write_table
    from paysight.sources.models import load_pipeline, requests_frame, save_model

    run = _models_folder(spark)
    write_table(silver_frame(spark, sf), f"{run}/silver")
    gold_rows = jobs.gold_job(spark, f"{run}/silver", f"{run}/gold", f"{run}/pipeline")
    save_model(train_lr(training_rows(gold_rows, False, EXACT, 80, False)[0], LR_V1), f"{run}/lr_v1")
    level = ["EdLevel", "RemoteWork"]
    usable = _requests(spark.read.parquet(f"{run}/silver"))
    # answers of two closed questions: a few dozen rows whatever the table
    asked = usable.groupBy(*level).agg(*[F.max(c).alias(c) for c in usable.columns if c in REQUEST_FIELDS])
    requests = requests_frame(spark, [r.asDict() for r in asked.collect()])
    request = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("-")) for c in level])
    write_table(requests.withColumn("request", request), f"{run}/requests")
    scored = jobs.score_job(spark, f"{run}/requests", f"{run}/pipeline", f"{run}/lr_v1", "lr", f"{run}/scores")
    filled = fill_text(spark.read.parquet(f"{run}/requests"), empty_too=True)
    long = slots.long_features(filled, slots.feature_slots(spark, load_pipeline(f"{run}/pipeline")), ["request"])
    own = slots.linear_scores(long, slots.saved_weights(spark, f"{run}/lr_v1"), ["request"])
    own = own.select("request", F.col("pred_log").alias("own_log"), F.col("salary_pred").alias("own_salary"))
    close = lambda x, y: F.coalesce(F.abs(F.col(x) - F.col(y)) <= 1e-8 * (1 + F.abs(x)), F.lit(False))
    agrees = close("pred_log", "own_log") & close("salary_pred", "own_salary")
    return scored.join(own, "request", "left").select("request", *REQUEST_FIELDS, agrees.alias("agrees"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "survey_base": q_survey_base,
    "union_strict": q_union_strict,
    "union_null_fill": q_union_null_fill,
    "tolerant_select": q_tolerant_select,
    "safe_cast": q_safe_cast,
    "pop_filter": q_pop_filter,
    "positive_filter": q_positive_filter,
    "trim_outliers": q_trim_outliers,
    "upper_cut": q_upper_cut,
    "drop_any_null": q_drop_any_null,
    "parse_years": q_parse_years,
    "parse_age": q_parse_age,
    "group_rare": q_group_rare,
    "impute_median": q_impute_median,
    "fill_text": q_fill_text,
    "silver_full": q_silver_full,
    "profile_year": q_profile_year,
    "profile_table": q_profile_table,
    "missing_rates": q_missing_rates,
    "group_quartiles": q_group_quartiles,
    "top_groups": q_top_groups,
    "salary_trend": q_salary_trend,
    "salary_quantiles": q_salary_quantiles,
    "hist_raw": q_hist_raw,
    "hist_log": q_hist_log,
    "corr_matrix": q_corr_matrix,
    "hash_sample": q_hash_sample,
    "hash_split": q_hash_split,
    "index_labels": q_index_labels,
    "one_hot": q_one_hot,
    "tokens": q_tokens,
    "token_counts": q_token_counts,
    "assemble_scale": q_assemble_scale,
    "features_gold": q_features_gold,
    "lr_ridge_1f": q_lr_ridge_1f,
    "lr_enet_1f": q_lr_enet_1f,
    "metrics_from_predictions": q_metrics_from_predictions,
    "best_model": q_best_model,
    "diagnostics_lr": q_diagnostics_lr,
    "train_lr_full": q_train_lr_full,
    "train_v1": q_train_v1,
    "train_v2": q_train_v2,
    "batch_score": q_batch_score,
    "score_features": q_score_features,
    "scatter_bins": q_scatter_bins,
    "hash_split_keys": q_hash_split_keys,
    "bronze_two_years": q_bronze_two_years,
    "run_report": q_run_report,
    "index_many": q_index_many,
    "csv_splits": q_csv_splits,
    "profile_growing": q_profile_growing,
    "trend_growing": q_trend_growing,
    "diagnostics_scatter": q_diagnostics_scatter,
    "stream_landing": q_stream_landing,
    "eda_charts": q_eda_charts,
    "jobs_silver": q_jobs_silver,
    "jobs_score": q_jobs_score,
}
