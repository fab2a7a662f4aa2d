"""Session settings, shared scratch space and size-checked lookups."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup is broadcast up to this size, measured as JSON text, which is longer than Spark's own rows.
BROADCAST_BYTES = 64 << 20
# Rows of a few numbers each stay far below that.
BROADCAST_ROWS = 200_000
# Rows with a payload that one task takes from a shuffle, so that what it sorts does not grow with the input.
TASK_ROWS = 250_000
# Settings of Python workers: a task has one core, and what it frees goes back to the machine, so that
# workers that are used again do not keep the most that any of their tasks needed.
WORKER_ENVIRONMENT = {
    "OPENBLAS_NUM_THREADS": "1",
    "OMP_NUM_THREADS": "1",
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_TRIM_THRESHOLD_": "1048576",
    "MALLOC_MMAP_THRESHOLD_": "1048576",
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}
# Bytes of an Arrow batch, which the executor and its worker hold several times over; Spark's own limit is 64 MB.
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "8m"


def use_utc(spark: SparkSession) -> SparkSession:
    """Time buckets and time texts are UTC, so the session zone has to be."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def share_package(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, for checkouts that are not
    installed, and keep them small. The folder has to be there on every machine; otherwise install the package
    or ship it with ``--py-files``. A limit of Arrow batches that the session has stays."""
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, BATCH_BYTES)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name, value in WORKER_ENVIRONMENT.items():
        spark.sparkContext.environment.setdefault(name, value)
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` where the cluster names one."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="relayframe-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path of its own for each run."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise a frame in shared storage and cut its lineage."""
    shared_dir(df.sparkSession)
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def tasks_for(spark: SparkSession, n_rows: int) -> int:
    """Tasks for a shuffle of so many rows: as many as the session says, or more if those took too many each."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // TASK_ROWS))


def is_small(lookup: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a lookup may be broadcast, by its measured size."""
    size = lookup.agg(F.sum(F.octet_length(F.to_json(F.struct(*lookup.columns))))).first()[0] or 0
    return size <= max_bytes


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join a lookup of one row per key onto a large frame.

    The lookup is measured first. Within ``max_bytes`` it is broadcast, so the large side keeps its
    partitioning and a hot key costs nothing. Beyond it this is a plain equi-join, whose skewed
    partitions AQE splits. A lookup that is costly to compute should be checkpointed before.
    """
    if is_small(lookup, max_bytes):
        lookup = F.broadcast(lookup)
    return big.join(lookup, list(keys), how)
