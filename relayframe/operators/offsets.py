"""High-water marks: what has been delivered, and what a replay repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from relayframe.session import lookup_join

PARTITION = ("topic", "partition")
RESTORE_PARTITION = ("topic", "partition", "bucket")


def last_offsets(log: DataFrame, keys: Sequence[str] = PARTITION) -> DataFrame:
    """Last offset per partition. The partial aggregate leaves one row per key and task to shuffle."""
    return log.groupBy(*keys).agg(F.max("offset").alias("offset"))


def merge_offsets(old: DataFrame, new: DataFrame, keys: Sequence[str] = PARTITION) -> DataFrame:
    """New state of the marks; a mark never moves backwards."""
    columns = [*keys, "offset"]
    return last_offsets(old.select(columns).unionByName(new.select(columns)), keys)


def marks_before(ledger: DataFrame, batch_id: int, run: str | None = None) -> DataFrame:
    """Marks of all batches but this one and later ones of the same run.

    Without this a retried batch would meet its own marks and filter itself out.
    """
    earlier = F.col("batch_id") < batch_id
    if run is not None:
        earlier = earlier | (F.col("run") != run)
    return last_offsets(ledger.where(earlier))


def with_mark(log: DataFrame, marks: DataFrame, keys: Sequence[str] = PARTITION) -> DataFrame:
    """Add the stored offset of each record's partition as ``mark`` (null if never seen)."""
    return lookup_join(log, marks.select(*keys, F.col("offset").alias("mark")), keys)


def is_replay() -> Column:
    return F.coalesce(F.col("offset") <= F.col("mark"), F.lit(False))


def fresh_records(log: DataFrame, marks: DataFrame, keys: Sequence[str] = PARTITION) -> DataFrame:
    """Records above their partition's mark. Compares offsets, so gaps in them lose nothing."""
    return with_mark(log, marks, keys).where(~is_replay()).drop("mark").select(log.columns)


def skipped_ranges(log: DataFrame, marks: DataFrame, keys: Sequence[str] = PARTITION) -> DataFrame:
    """First and last replayed offset of each partition that has any."""
    return (
        with_mark(log, marks, keys)
        .where(is_replay())
        .groupBy(*keys)
        .agg(
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
            F.count(F.lit(1)).alias("n_skipped"),
        )
    )


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Count rows (and other aggregates) of a frame while it is written, without a second pass."""
    observation = Observation(name)
    metrics = metrics or {"n_rows": F.count(F.lit(1))}
    return df.observe(observation, *[expr.alias(k) for k, expr in metrics.items()]), observation


def topics_of(log: DataFrame) -> DataFrame:
    return log.select("topic").distinct()


def batch_sizes(log: DataFrame, batch: Column) -> DataFrame:
    """Records per topic and batch."""
    return log.groupBy("topic", batch.alias("batch")).agg(F.count(F.lit(1)).alias("n_rows"))
