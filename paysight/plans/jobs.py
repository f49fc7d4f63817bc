"""Stage jobs: raw CSV -> bronze -> silver -> gold -> models -> EDA / scores.

Each job reads its input from storage and writes its output, so stages can
run as separate applications (as the original scripts do) or be chained in
one session. The caller's session is used; a command-line entry is given
for convenience::

    python -m paysight.plans.jobs bronze --raw 2021=/data/raw/2021.csv ... --out /data/bronze
    python -m paysight.plans.jobs silver --bronze /data/bronze --out /data/silver
    python -m paysight.plans.jobs gold   --silver /data/silver --out /data/gold --pipeline /models/features
    python -m paysight.plans.jobs train  --gold /data/gold --models /models --version v2 --metrics /data/metrics
    python -m paysight.plans.jobs eda    --silver /data/silver --out /data/eda
    python -m paysight.plans.jobs score  --requests /data/requests --pipeline /models/features \
                                         --model /models/gbt_v1 --kind gbt --out /data/scores
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysight.operators.models import best_model, diagnostics, with_label
from paysight.operators.models import score as score_rows
from paysight.operators.profile import profile
from paysight.plans.eda import eda as eda_tables
from paysight.plans.gold import gold as gold_stage
from paysight.plans.gold import train as train_stage
from paysight.plans.gold import row_keys
from paysight.plans.silver import SilverModel, SilverParams, silver_and_model
from paysight.schema import TARGET, YEAR
from paysight.sources.files import read_bronze, read_survey_years, write_bronze, write_table
from paysight.sources.models import load_pipeline, load_regressor, save_model


def bronze(
    spark: SparkSession, raw: Mapping[int, str], out: str, null_value: str | None = None, split_bytes: int | None = None
) -> DataFrame:
    """Land every yearly file as one year-partitioned table; returns the
    per-year profile (rows, salary present/missing, mean, median). ``split_bytes`` reads large
    files in byte ranges."""
    df = read_survey_years(spark, raw, null_value=null_value, split_bytes=split_bytes)
    write_bronze(df, out)
    return profile(read_bronze(spark, out), TARGET, by=[YEAR])


def silver_job(
    spark: SparkSession, bronze_path: str, out: str, params: SilverParams | None = None, model_path: str | None = None
) -> DataFrame:
    """The silver table; ``model_path`` also keeps the fit, for scoring raw rows later."""
    df, model = silver_and_model(read_bronze(spark, bronze_path), params)
    write_table(df, out)
    if model_path:
        model.save(spark, model_path)
    return spark.read.parquet(out)


def gold_job(spark: SparkSession, silver_path: str, out: str, pipeline_path: str, partitions: int | None = None):
    g, model = gold_stage(spark.read.parquet(silver_path))
    write_table(g, out, partitions)
    save_model(model, pipeline_path)
    return spark.read.parquet(out)


def train_job(spark: SparkSession, gold_path: str, models_dir: str, version: str = "v1", metrics_path: str | None = None):
    """Fit both models; each is saved under a versioned path and the
    metrics table marks the best one (lowest log RMSE, ties to LR)."""
    res = train_stage(spark.read.parquet(gold_path), version)
    for name, model in res.models.items():
        save_model(model, f"{models_dir.rstrip('/')}/{name}")
    m = res.metrics
    best = best_model(m).first()["model"]
    m = m.withColumn("best", F.col("model") == F.lit(best))
    if metrics_path:
        write_table(m, metrics_path)
    return m


def eda_job(
    spark: SparkSession, silver_path: str, out: str, gold_path: str | None = None, models: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """Every chart's table; with gold and saved models (name -> path, names starting ``lr`` or ``gbt``) also
    each model's diagnostics over all gold rows (C9)."""
    tables = eda_tables(spark.read.parquet(silver_path))
    for name, path in (models or {}).items():
        regressor = load_regressor(path, "lr" if name.startswith("lr") else "gbt")
        pred = regressor.transform(with_label(spark.read.parquet(gold_path)))
        tables |= {f"{name}_{k}": v for k, v in diagnostics(pred, row_keys(pred)).items()}
    for name, df in tables.items():
        write_table(df, f"{out.rstrip('/')}/{name}")
    return tables


def score_job(
    spark: SparkSession, requests_path: str, pipeline_path: str, model_path: str, kind: str, out: str, silver_model: str | None = None
):
    """Score request rows; with ``silver_model`` they are raw survey rows and get the fitted silver treatment first."""
    requests = spark.read.parquet(requests_path)
    if silver_model:
        requests = SilverModel.load(spark, silver_model).transform(requests, filter_rows=False)
    scored = score_rows(requests, load_pipeline(pipeline_path), load_regressor(model_path, kind))
    made = ("features", "features_raw", *[c for c in scored.columns if c.endswith(("_idx", "_vec", "_tokens", "_counts"))])
    write_table(scored.drop(*made), out)
    return spark.read.parquet(out)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="paysight.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    b = sub.add_parser("bronze")
    b.add_argument("--raw", nargs="+", required=True, help="YEAR=PATH pairs")
    b.add_argument("--out", required=True)
    b.add_argument("--null-value", help="marker of a null field; by default empty fields are null")
    b.add_argument("--split-bytes", type=int, help="read files in byte ranges of this size, each a task")
    s = sub.add_parser("silver")
    s.add_argument("--bronze", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--rel-error", type=float, default=1e-4)
    s.add_argument("--min-country", type=int, default=100)
    s.add_argument("--model", help="where to keep the fit, for scoring raw rows")
    g = sub.add_parser("gold")
    g.add_argument("--silver", required=True)
    g.add_argument("--out", required=True)
    g.add_argument("--pipeline", required=True)
    t = sub.add_parser("train")
    t.add_argument("--gold", required=True)
    t.add_argument("--models", required=True)
    t.add_argument("--version", default="v1", choices=["v1", "v2"])
    t.add_argument("--metrics")
    e = sub.add_parser("eda")
    e.add_argument("--silver", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--gold", help="gold table, for the diagnostics of --models")
    e.add_argument("--models", nargs="+", default=[], help="NAME=PATH pairs of saved models, names starting lr or gbt")
    c = sub.add_parser("score")
    c.add_argument("--requests", required=True)
    c.add_argument("--pipeline", required=True)
    c.add_argument("--model", required=True)
    c.add_argument("--kind", default="gbt", choices=["gbt", "lr"])
    c.add_argument("--out", required=True)
    c.add_argument("--silver-model", help="saved fit of the silver stage; the requests are raw survey rows then")
    args = ap.parse_args(argv)
    if args.job == "eda" and args.models and not args.gold:
        ap.error("--models needs --gold")
    spark = SparkSession.builder.getOrCreate()
    if args.job == "bronze":
        raw = {int(k): v for k, v in (p.split("=", 1) for p in args.raw)}
        bronze(spark, raw, args.out, args.null_value, args.split_bytes).show(truncate=False)
    elif args.job == "silver":
        silver_job(spark, args.bronze, args.out, SilverParams(rel_error=args.rel_error, min_country=args.min_country), args.model)
    elif args.job == "gold":
        gold_job(spark, args.silver, args.out, args.pipeline)
    elif args.job == "train":
        train_job(spark, args.gold, args.models, args.version, args.metrics).show(truncate=False)
    elif args.job == "eda":
        eda_job(spark, args.silver, args.out, args.gold, dict(p.split("=", 1) for p in args.models))
    elif args.job == "score":
        score_job(spark, args.requests, args.pipeline, args.model, args.kind, args.out, args.silver_model)


if __name__ == "__main__":
    main()
