"""A corpus pipeline over ``documents``, stage by stage.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. Its result is
written as Parquet and read again as the next stage's docs, so a lost executor never costs more than
the stage it was in. All but the last stage return the columns of ``documents``.

Each stage is defined for null and empty texts, null and repeated ids, repeated rows, empty tables
and further columns: the quality stage scores an empty text like any other; near-dedup links texts
without words and keeps one of them, and the row with the smallest id of each group; decontamination
and the secret scan leave texts without words or candidates as they are; packing gives every
remaining row at least one part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysight.llm.common import Scratch, fresh, table
from paysight.llm.decontaminate import drop_contaminated
from paysight.llm.packing import pack_documents, word_lengths
from paysight.llm.quality import THRESHOLD, learn_quality, quality_score, text_statistics
from paysight.llm.secrets import learn_secrets, redact_secrets
from paysight.llm.simhash import keep_one


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose quality score reaches the threshold."""
    stats = text_statistics(F.col("text"))
    model = learn_quality(docs.select("doc_id", stats.alias("stats")), table(spark, sf_dir, "labels"))
    score = fresh(docs, "_score")
    scored = docs.withColumn(score, quality_score(stats, model, spark))
    return scored.filter(F.col(score) >= THRESHOLD).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: 4-word shingles, fingerprints linked at 4 or fewer differing bits."""
    return keep_one(docs, shingle=4, max_bits=4)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not contaminated by benchmark passages."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with the secrets in their texts masked and n_chars following."""
    length = "n_chars" if "n_chars" in docs.columns else None
    return redact_secrets(docs, learn_secrets(docs), length_col=length)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's parts and the bins they are packed in."""
    return pack_documents(word_lengths(docs), "n_words")


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scan", secret_stage),
    ("best-fit packing", packing_stage),
]

# Fingerprints, a forest and best-fit packing are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            scratch.drop(f"stage-{k - 1}")
    return docs
