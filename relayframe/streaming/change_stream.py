"""Change logs whose relations come in the log, between the changes that they describe."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from relayframe.operators.changes import relations_in_log
from relayframe.plans.changefeed import ChangeFeed, in_log_order
from relayframe.schemas import RELATION_VERSIONS
from relayframe.session import checkpointed
from relayframe.streaming.triggers import every


@dataclass
class RelationLog:
    """Relation versions that a stream has met: a folder for each batch that brought one.

    A relation that is sent again as it was, as sources do after each connection, is no new version, so the
    folder grows with changes to tables only. A batch that is run again replaces what it stored.
    """

    path: str

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Versions that earlier batches stored."""
        try:
            stored = spark.read.option("basePath", self.path).parquet(self.path)
        except AnalysisException as error:
            # No folder yet, or one that only a batch without versions has touched.
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return spark.createDataFrame([], RELATION_VERSIONS)
        return stored.where(F.col("batch_id") < batch_id).select(*RELATION_VERSIONS.fieldNames())

    def store(self, sent: DataFrame, batch_id: int) -> DataFrame:
        """Stores the versions that a batch brought; gives all that hold for it."""
        spark = sent.sparkSession
        names = RELATION_VERSIONS.fieldNames()
        known = self.before(spark, batch_id)
        latest = known.groupBy("relation_id").agg(F.max_by(F.struct(*names), "since").alias("v")).select("v.*")
        content = F.struct("namespace", "name", "columns")
        order = Window.partitionBy("relation_id").orderBy("since")
        both = latest.withColumn("is_new", F.lit(False)).unionByName(sent.select(*names).distinct().withColumn("is_new", F.lit(True)))
        changed = both.withColumn("again", F.lag(content).over(order).eqNullSafe(content)).where("is_new and not again")
        # A row for each table that was described in this batch.
        fresh = checkpointed(changed.select(*names))
        if not fresh.isEmpty():
            fresh.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        return known.unionByName(fresh)


def start_change_stream(
    log: DataFrame,
    feed: ChangeFeed,
    relations: RelationLog,
    send: Callable[[DataFrame, int], None],
    checkpoint: str,
    timeout: str | None = None,
) -> StreamingQuery:
    """Sends the changes of a log with relations in it (``LOG_WITH_RELATIONS``), each decoded by the version
    of its relation that holds at its position, whether that came in this batch or in an earlier one.

    Messages of one key are sent in the order of the log. A batch that fails is sent again as a whole.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        versions = relations.store(relations_in_log(batch), batch_id)
        send(in_log_order(feed.looked_up_messages(batch, versions, ("lsn_start",))), batch_id)

    writer = log.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**every(timeout)).start()
