"""Row-change logs kept as files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from relayframe.operators.changes import next_position, since_position
from relayframe.schemas import CHANGES


def read_changes(
    spark: SparkSession, path: str, position: int | None = None, schema: T.StructType = CHANGES
) -> DataFrame:
    """Changes from a log position on."""
    return since_position(spark.read.schema(schema).parquet(path), position)


def stream_changes(
    spark: SparkSession,
    path: str,
    position: int | None = None,
    schema: T.StructType = CHANGES,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Changes as they arrive; the checkpoint remembers how far, ``position`` is where to begin."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return since_position(reader.parquet(path), position)


def write_changes(changes: DataFrame, path: str) -> None:
    """Keep changes by relation, so that subscribing to some tables reads only theirs."""
    changes.write.mode("append").partitionBy("relation").parquet(path)


def store_position(changes: DataFrame, path: str, batch_id: int = 0) -> None:
    """Remember where a bounded run ended, after its messages are written."""
    reached = next_position(changes).where("position IS NOT NULL")
    reached.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def stored_position(spark: SparkSession, path: str) -> int | None:
    """Where the next bounded run begins; None for the first."""
    try:
        stored = spark.read.schema("position bigint").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return next_position(stored.withColumnRenamed("position", "lsn_end")).first()["position"]
