"""Topics to tables, where a delivery repeated has no effect."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from relayframe.operators import offsets
from relayframe.operators.decode import Decoder, json_decoder, project, split_malformed
from relayframe.operators.routing import Routes, route_table
from relayframe.session import checkpointed
from relayframe.streaming.triggers import every

# A hook gets a batch's records of one topic group and gives rows of the target table.
Hook = Callable[[DataFrame, str], DataFrame]
# A writer appends rows to a table; run and batch_id identify the batch for those that can replace it.
Writer = Callable[[DataFrame, str, str, int], None]

STATE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("n_rows", T.LongType()),
    ]
)
_LEDGER = T.StructType(
    [*STATE.fields, T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())]
)


def parquet_writer(root: str) -> Writer:
    """Tables as parquet, one directory per batch, so that a retried batch replaces itself."""

    def write(rows: DataFrame, table: str, run: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{root}/{table}/run={run}/batch_id={batch_id}")

    return write


def read_table(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    """A table that :func:`parquet_writer` wrote."""
    return spark.read.schema(schema).parquet(f"{root}/{table}").select(schema.names)


def jdbc_writer(url: str, batch_size: int = 10_000, login: Mapping[str, str] | None = None) -> Writer:
    """Database tables. An append cannot be replaced: a batch that fails between this and the
    ledger is appended again unless the table itself merges by topic, partition and offset."""
    from relayframe.sources.tables import append_rows

    def write(rows: DataFrame, table: str, run: str, batch_id: int) -> None:
        append_rows(rows, url, table, batch_size, login)

    return write


class Ledger:
    """Marks of every finished batch.

    Each batch stores the whole state (one row per topic partition), so the next reads one
    directory however long the job has run. A new checkpoint starts a new run, which begins from
    all earlier ones.
    """

    def __init__(self, root: str):
        self.root = root

    def _state(self, spark: SparkSession, run: str, batch_id: int) -> DataFrame:
        return spark.read.schema(STATE).parquet(f"{self.root}/run={run}/batch_id={batch_id}")

    def all_marks(self, spark: SparkSession) -> DataFrame:
        try:
            return spark.read.schema(_LEDGER).parquet(self.root)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], _LEDGER)

    def before(self, spark: SparkSession, run: str, batch_id: int) -> DataFrame:
        if batch_id > 0:
            try:
                return self._state(spark, run, batch_id - 1)
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
        return offsets.marks_before(self.all_marks(spark), batch_id, run)

    def store(self, state: DataFrame, run: str, batch_id: int) -> None:
        # One row per topic partition: a single small file.
        state.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/run={run}/batch_id={batch_id}")


@dataclass
class TableSink:
    """Writes log batches to tables; call it from ``foreachBatch`` or directly.

    Per batch: drop records at or below the stored marks, route topics to tables, decode values
    onto each table's columns (or hand the records to a hook), write, then store the new marks.
    """

    # Columns by table, or a function that looks them up for each batch, as the target may change.
    tables: Mapping[str, T.StructType] | Callable[[], Mapping[str, T.StructType]]
    ledger: Ledger
    write: Writer
    routes: Routes = ()
    decoder: Decoder = field(default_factory=json_decoder)
    hook: Hook | None = None
    keep: tuple[str, ...] = ()
    # Where malformed JSON records go; without it they fail the batch. Only the JSON decoder can tell them.
    quarantine: Writer | None = None

    def __post_init__(self) -> None:
        if self.quarantine is not None and not hasattr(self.decoder, "json_time_format"):
            raise ValueError("a quarantine needs the JSON decoder; another decoder cannot tell malformed records")

    def _routed(self, batch: DataFrame) -> DataFrame:
        table = route_table(F.col("topic"), self.routes)
        known = F.when(table.isin(*self._tables), table).otherwise(
            F.raise_error(F.concat(F.lit("the target lists no columns of "), table))
        )
        return batch.withColumn("_table", known)

    def _write_table(self, fresh: DataFrame, table: str, run: str, batch_id: int) -> None:
        records = fresh.where(F.col("_table") == table).drop("_table")
        schema = self._tables[table]
        if self.hook is not None:
            rows = self.hook(records, table)
        elif self.quarantine is not None:
            rows, malformed = split_malformed(records, schema, self.decoder.json_time_format, self.keep)
            self.quarantine(malformed, table, run, batch_id)
        else:
            rows = project(records, schema, self.decoder, self.keep)
        self.write(rows, table, run, batch_id)

    def __call__(self, batch: DataFrame, batch_id: int, run: str | None = None) -> None:
        spark = batch.sparkSession
        run = run or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "manual"
        marks = self.ledger.before(spark, run, batch_id).select("topic", "partition", "offset")
        self._tables = self.tables() if callable(self.tables) else self.tables
        # The batch is read once per table and once for its marks.
        batch = batch.persist()
        try:
            fresh = self._routed(_without_repeats(offsets.fresh_records(batch, marks)))
            # At most one row per configured table: any other name has failed by now.
            for row in fresh.select("_table").distinct().collect():
                self._write_table(fresh, row["_table"], run, batch_id)
            counts = batch.groupBy("topic", "partition").agg(
                F.max("offset").alias("offset"), F.count(F.lit(1)).alias("n_rows")
            )
            state = (
                marks.withColumn("n_rows", F.lit(0).cast("bigint"))
                .unionByName(counts)
                .groupBy("topic", "partition")
                .agg(F.max("offset").alias("offset"), F.sum("n_rows").alias("n_rows"))
            )
            self.ledger.store(state, run, batch_id)
        finally:
            batch.unpersist()


def _without_repeats(records: DataFrame) -> DataFrame:
    """One copy of each record. Only numbers are compared to find out whether a batch holds any repeat."""
    keys = ["topic", "partition", "offset"]
    if records.groupBy(*keys).count().where("count > 1").isEmpty():
        return records
    return records.dropDuplicates(keys)


def start_table_sink(
    log: DataFrame, sink: TableSink, checkpoint: str, timeout: str | None = "5s"
) -> StreamingQuery:
    """Run a sink on a streaming log; without a timeout it takes what is there and stops."""
    return (
        log.writeStream.foreachBatch(lambda batch, batch_id: sink(batch, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**every(timeout))
        .start()
    )


def drain(queries: Sequence[StreamingQuery]) -> None:
    """Wait for bounded runs to end, raising what made one fail."""
    for query in queries:
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()


def load_batch(sink: TableSink, batch: DataFrame, batch_id: int, run: str) -> None:
    """Deliver one bounded frame as a numbered batch."""
    sink(checkpointed(batch), batch_id, run)
