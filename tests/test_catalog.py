"""Catalogue queries against their DuckDB texts on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_mod
from paysight.plans.catalog import QUERIES
from paysight.plans.oracle import ORACLE
from paysight.sources.tables import TABLES

SF_SMALL = "/root/testdata/sf0.001"

FAST = [
    "survey_base",
    "union_null_fill",
    "pop_filter",
    "trim_outliers",
    "parse_years",
    "parse_age",
    "group_rare",
    "impute_median",
    "silver_full",
    "profile_year",
    "missing_rates",
    "group_quartiles",
    "hist_log",
    "corr_matrix",
    "hash_split",
    "index_labels",
    "one_hot",
    "token_counts",
    "lr_enet_1f",
    "best_model",
    "stream_landing",
    "features_gold",
    "train_lr_full",
    "score_features",
    "scatter_bins",
    "hash_split_keys",
    "bronze_two_years",
    "union_strict",
    "eda_charts",
    "jobs_silver",
    "jobs_score",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _rows(values):
    return sorted((tuple(repr(v) for v in r) for r in values), key=repr)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    sdf = entry_mod.queries()[name](spark, SF_SMALL)
    rel = duck.sql(entry_mod.oracle_sql()[name])
    cols = sorted(sdf.columns)
    assert cols == sorted(rel.columns)
    idx = {c: i for i, c in enumerate(rel.columns)}
    s = _rows(tuple(r[c] for c in cols) for r in sdf.collect())
    d = _rows(tuple(r[idx[c]] for c in cols) for r in rel.fetchall())
    assert s == d


def test_every_checked_query_has_oracle():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    q, o = QUERIES, ORACLE  # the text operators test their own
    assert set(q) == set(o)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["dimension", "value", "n", "p25", "median_salary", "p75", "err_low", "err_high"]
