import re

import corpus_pipeline as C
import pytest
from pyspark.sql import functions as F

from paysight.llm import decontaminate as D
from paysight.llm import packing as P
from paysight.llm import quality as Q
from paysight.llm import simhash as S

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Every stage's input and output."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in C.STAGES:
        after = stage(spark, docs, SF).cache()
        out.append((docs, after))
        docs = after
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_all_but_the_last_keep_the_columns(stages):
    for docs, after in stages[:-1]:
        assert after.columns == docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_stage_keeps_what_the_model_predicts(spark, stages):
    docs, after = stages[0]
    rows = docs.select("doc_id", Q.text_statistics(F.col("text")).alias("stats"))
    model = Q.learn_quality(rows, spark.read.parquet(f"{SF}/labels.parquet"))
    scored = rows.select("doc_id", Q.quality_score(F.col("stats"), model, spark).alias("s"))
    assert ids(after) == ids(scored.filter(F.col("s") >= 0.3)) and 0 < after.count() < docs.count()


def test_dedup_stage_keeps_one_of_each_component(stages):
    docs, after = stages[1]
    found = S.near_duplicates(docs)
    assert ids(after) == ids(found.filter("doc_id = component_id"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(texts[r.doc_id] == r.text for r in after.collect())


def test_decontamination_stage_drops_what_the_query_marks(spark, stages):
    docs, after = stages[2]
    scanned = D.scan_documents(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert ids(after) == ids(scanned.filter(~D.is_contaminated(F.col("scan"))))


def test_secret_stage_keeps_all_rows_and_hides_planted_secrets(stages):
    docs, after = stages[3]
    assert ids(after) == ids(docs)
    for r in after.collect():
        assert not re.search(r'(password=|token = ")[0-9a-f]{12}|AKIA[0-9A-Z]{16}', r.text) and r.n_chars == len(r.text)


def test_packing_stage_places_every_word(stages):
    docs, after = stages[4]
    words = {r.doc_id: r.n_words for r in P.word_lengths(docs).collect()}
    packed = {r.doc_id: r.n for r in after.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert packed == words


def test_run_equals_the_stages(spark, stages):
    assert sorted(map(tuple, C.run(spark, SF).collect())) == sorted(map(tuple, stages[-1][1].collect()))


@pytest.mark.parametrize("kind", ["edges", "empty"])
def test_every_stage_takes_edge_cases(spark, edge_docs, make_docs, kind):
    docs = edge_docs if kind == "edges" else make_docs([])
    for _, stage in C.STAGES:
        after = stage(spark, docs, SF)
        n = after.count()
        assert n >= 0 if kind == "edges" else n == 0
