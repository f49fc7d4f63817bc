"""Session-level helpers: checkpointing and size-checked broadcast.

The library never builds a session. These helpers only read settings from
the session they are handed.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# Largest table we broadcast: rows, and bytes of their texts and numbers.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and about the bytes of ``df``, in one aggregation: texts by their length, all else as 16 bytes."""
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    length = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in texts), F.lit(16 * len(df.columns)).cast("bigint"))
    rows, size = df.agg(F.count(F.lit(1)), F.sum(length)).first()
    return int(rows), int(size or 0)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, if any.

    ``SparkContext.getCheckpointDir`` is set when ``spark.checkpoint.dir``
    was given at start-up or someone called ``setCheckpointDir``. A value
    only present in the SQL conf is applied to the context here.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no SparkContext
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    return None


def maybe_broadcast(
    df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS
) -> tuple[DataFrame, bool]:
    """Broadcast ``df`` only when its row count is proven to be small.

    The count is one action over ``df``; callers pass small derived tables
    (dimension tables, per-key aggregates), never the fact side. Beyond the
    bound the frame is returned unchanged, so the join falls back to a
    shuffle join where AQE can split skewed partitions.
    """
    n, size = measure(df)
    if n <= max_rows and size <= MAX_BROADCAST_BYTES:
        return F.broadcast(df), True
    return df, False


class SmallTable:
    """A small derived table, materialised once and counted.

    It is written as a table into the shared checkpoint folder when one is
    configured and persisted otherwise (lost blocks are then recomputed from lineage).
    ``rows`` is exact, so the broadcast decision rests on a checked size.
    """

    def __init__(self, df: DataFrame, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS):
        if checkpoint_dir(df.sparkSession) is not None:
            # one job writes it (a reliable RDD checkpoint would compute it
            # twice); no coalesce, which would pull the upstream aggregation
            # into one task — AQE sizes the output partitions
            self.df = stage_table(df, "small")
            self.persisted = False
        else:
            self.df = df.persist()
            self.persisted = True
        self.rows, self.bytes = measure(self.df)
        self.max_broadcast_rows = max_broadcast_rows

    @property
    def small(self) -> bool:
        return self.rows <= self.max_broadcast_rows and self.bytes <= MAX_BROADCAST_BYTES

    def for_join(self) -> DataFrame:
        """The table with a broadcast hint when (and only when) it is small."""
        return F.broadcast(self.df) if self.small else self.df

    def release(self) -> None:
        if self.persisted:
            self.df.unpersist()


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    read it back, so several passes (model fits) read a columnar table
    instead of re-deriving a long lineage. Without a configured folder the
    frame is persisted instead (lost blocks are recomputed)."""
    root = checkpoint_dir(df.sparkSession)
    if root is None:
        out = df.persist()
        out.count()
        return out
    path = f"{root.rstrip('/')}/paysight-stage/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


# What spreading costs little for, and a split too large to leave to one task.
CHEAP_BYTES = 1 << 30
LARGE_SPLIT_BYTES = 512 << 20


def ensure_parallelism(df: DataFrame) -> DataFrame:
    """Spread an under-partitioned input over the cluster's cores.

    A scan of one unsplittable file (one Parquet row group) is a single task, and every narrow
    operator after it stays in that task. When the scan yields fewer partitions than
    ``spark.default.parallelism`` it is round-robin repartitioned to that number, but only if that is
    cheap (the input is below ``CHEAP_BYTES``) or its splits are larger than ``LARGE_SPLIT_BYTES``. A
    large, well-split table is never shuffled just because the cluster has more cores than it has splits.
    """
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        partitions = df.rdd.getNumPartitions()
        size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # no RDD view of the plan (remote session): leave it
        return df
    if partitions < target and (size <= CHEAP_BYTES or size > LARGE_SPLIT_BYTES * max(1, partitions)):
        return df.repartition(target)
    return df


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate files: the shared ``spark.checkpoint.dir``.

    Only a local-mode session without one gets a temporary folder (as tests
    do); on a cluster an unset checkpoint folder is an error, never a
    machine-local path.
    """
    root = checkpoint_dir(spark)
    if root is not None:
        return root
    if spark.sparkContext.master.startswith("local"):
        import tempfile

        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="paysight-ckpt-"))
        return spark.sparkContext.getCheckpointDir()
    raise ValueError("set spark.checkpoint.dir to a shared folder")
