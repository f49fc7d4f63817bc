"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paysight.runtime import scratch_root

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Words of the license and decontamination contracts: ASCII letters and digits and everything beyond ASCII.
WORD_PATTERN = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

# Maps every byte for that pattern: A-Z to a-z, the separators to a space, the rest to itself.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


class Scratch:
    """Intermediate Parquet tables of one run, in the folder ``spark.checkpoint.dir`` names.

    A written table cuts the lineage: a lost executor costs the tasks that read it, not the steps
    before it. ``drop`` removes tables that no frame reads any more; those a returned frame still
    reads stay until the owner of the folder clears it.
    """

    def __init__(self, spark: SparkSession, run: str):
        self.spark = spark
        self.root = f"{scratch_root(spark).rstrip('/')}/paysight-llm/{run}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
