"""A date range of an archive back to records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relayframe.operators import offsets
from relayframe.operators.archive import each_once, from_archive_rows, repeated_offsets
from relayframe.schemas import RESTORE_OFFSETS
from relayframe.session import checkpointed
from relayframe.sources import archive_files as files

# Marks are kept per bucket: with one mark per partition, a bucket holding high offsets would make
# the next one's lower offsets look restored.
_KEYS = offsets.RESTORE_PARTITION


@dataclass
class Restore:
    """Frames of one restore. No payload is read until one is used; disputed offsets are compared before.

    ``records`` go back to their topics and partitions. ``counters`` are per topic. ``marks`` is
    the ledger to store once the records are written.
    """

    records: DataFrame
    counters: DataFrame
    marks: DataFrame


def _no_marks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RESTORE_OFFSETS)


def _fresh(rows: DataFrame, marks: DataFrame | None) -> DataFrame:
    return rows if marks is None else offsets.fresh_records(rows, marks, _KEYS)


def _in_order(rows: DataFrame, wanted: bool) -> DataFrame:
    if not wanted:
        return rows
    return rows.repartition("topic", "partition").sortWithinPartitions("topic", "partition", "offset")


def restore(
    rows: DataFrame, marks: DataFrame | None = None, binary: str = "text", in_order: bool = False
) -> Restore:
    """Records of archive rows (``topic, bucket, partition`` plus the row fields), each once.

    Offsets alone are shuffled to find repeats, and then the rows that repeat. ``in_order`` then hands every topic partition to
    one task, in offset order, for sinks that must append in order. That task can be as large as
    the largest partition, so it is off by default.
    """
    known = _no_marks(rows.sparkSession) if marks is None else marks
    fresh = _fresh(rows, marks)
    repeated = files.repeated_records(fresh.select(*_KEYS, "offset"))
    return Restore(
        records=from_archive_rows(_in_order(each_once(fresh, repeated), in_order), binary),
        counters=restore_counters(rows, known),
        marks=offsets.merge_offsets(known, offsets.last_offsets(rows, _KEYS), _KEYS),
    )


def restore_counters(rows: DataFrame, marks: DataFrame, repeats: bool = True) -> DataFrame:
    """Restored and skipped rows per topic; further copies of a record count as skipped.

    Only the key columns are read, and shuffled where records may repeat.
    """
    if repeats:
        counted = rows.groupBy(*_KEYS, "offset").agg(F.count(F.lit(1)).alias("n"))
    else:
        counted = rows.select(*_KEYS, "offset", F.lit(1).cast("bigint").alias("n"))
    return (
        offsets.with_mark(counted, marks, _KEYS)
        .groupBy("topic")
        .agg(
            F.count_if(~offsets.is_replay()).alias("restored"),
            (F.sum("n") - F.count_if(~offsets.is_replay())).alias("skipped"),
        )
    )


def restore_archive(
    spark: SparkSession,
    root: str,
    topics: Sequence[str] | None = None,
    since: str | datetime | None = None,
    until: str | datetime | None = None,
    marks: DataFrame | None = None,
    binary: str = "text",
    in_order: bool = False,
    with_timestamp: bool = False,
    folders: Sequence[str] | None = None,
) -> Restore:
    """Restore topics and buckets of an archive.

    The listing tells which offsets more than one chunk may hold, and only those are compared, without
    their payload; which chunks lie wholly at or below their mark, and those are not read; and how many
    rows the others hold, so that marks and most counters need no reading. ``folders`` of an ``ArchiveLog`` narrow
    all of that to committed writes.
    """
    known = _no_marks(spark) if marks is None else marks
    manifest = checkpointed(files.list_archive(spark, root, topics, since, until, folders))
    rows = files.read_archive(spark, root, topics, since, until, with_timestamp, folders).drop("n_rows")
    chunks = offsets.with_mark(manifest, known, _KEYS)
    fresh = rows
    if marks is not None:
        fresh = files.rows_of_chunks(rows, checkpointed(files.chunk_key(chunks.where("mark IS NULL OR max_offset > mark"))))
    disputed = files.disputed_rows(fresh, manifest)
    tasks = files.listed_tasks(spark, manifest)
    repeated = files.repeated_records(None if disputed is None else _fresh(disputed, marks), tasks=tasks)
    records = each_once(_fresh(fresh, marks), repeated, tasks=tasks)
    return Restore(
        records=from_archive_rows(_in_order(records, in_order), binary),
        counters=_archive_counters(rows, repeated, chunks),
        marks=offsets.merge_offsets(known, manifest.withColumnRenamed("max_offset", "offset"), _KEYS),
    )


def _archive_counters(rows: DataFrame, repeated: DataFrame | None, chunks: DataFrame) -> DataFrame:
    """Counters from the listing, reading only the offsets of chunks that a mark cuts in two. Further copies
    of a repeated record count as skipped."""
    parts = []
    cut = F.coalesce((F.col("min_offset") <= F.col("mark")) & (F.col("mark") < F.col("max_offset")), F.lit(False))
    split = checkpointed(files.chunk_key(chunks.where(cut)))
    if not split.isEmpty():
        marks = chunks.where(cut).select(*_KEYS, F.col("mark").alias("offset")).distinct()
        parts.append(restore_counters(files.rows_of_chunks(rows, split), marks, repeats=False))
    done = F.coalesce(F.col("max_offset") <= F.col("mark"), F.lit(False))
    parts.append(
        chunks.where(~cut)
        .groupBy("topic")
        .agg(
            F.coalesce(F.sum(F.when(~done, F.col("n_rows"))), F.lit(0)).alias("restored"),
            F.coalesce(F.sum(F.when(done, F.col("n_rows"))), F.lit(0)).alias("skipped"),
        )
    )
    if repeated is not None:
        further = F.sum(F.col("n") - 1)
        parts.append(repeated.groupBy("topic").agg((-further).alias("restored"), further.alias("skipped")))
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("topic")
        .agg(F.sum("restored").alias("restored"), F.sum("skipped").alias("skipped"))
    )
