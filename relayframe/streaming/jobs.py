"""Jobs by class name, configured with plain dictionaries.

A configuration names what a job reads and writes; a frame or stream given under ``log``,
``changes`` or ``tables`` replaces the connector, which is how jobs run without one.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from relayframe.operators import offsets
from relayframe.operators.catalog import target_schema
from relayframe.operators.changes import next_position, relations_in_log, since_position
from relayframe.operators.decode import make_decoder
from relayframe.plans.changefeed import ChangeFeed, in_log_order
from relayframe.plans.restore import restore, restore_archive
from relayframe.plans.snapshot import SnapshotPlan, keyed_tables
from relayframe.schemas import CHANGES, LOG_WITH_RELATIONS, RAW_CHANGES, RESTORE_OFFSETS
from relayframe.session import checkpointed
from relayframe.sources import archive_files, kafka, tables
from relayframe.sources.archive_commits import ArchiveLog
from relayframe.sources.changelog import stored_position, stream_changes
from relayframe.streaming.archive_sink import ArchiveSink, start_archive_sink
from relayframe.streaming.change_stream import RelationLog, start_change_stream
from relayframe.streaming.table_sink import Ledger, TableSink, jdbc_writer, start_table_sink
from relayframe.streaming.triggers import every

Job = Callable[[SparkSession, dict[str, Any]], DataFrame | StreamingQuery]
_JOBS: dict[str, Job] = {}


def register(name: str) -> Callable[[Job], Job]:
    def add(job: Job) -> Job:
        _JOBS[name] = job
        return job

    return add


def get(name: str) -> Job:
    if name not in _JOBS:
        raise ValueError(f"unknown job class: {name}")
    return _JOBS[name]


def run(spark: SparkSession, name: str, conf: dict[str, Any]) -> DataFrame | StreamingQuery:
    return get(name)(spark, conf)


def _log(spark: SparkSession, conf: dict[str, Any]) -> DataFrame:
    if "log" in conf:
        return conf["log"]
    # Without a limit of its own a trigger reads all there is.
    options = {"batch_size": None} | conf["kafka"]
    if options.get("sasl"):
        options["sasl"] = kafka.sasl_options(**options["sasl"])
    return kafka.read_topics(spark, kafka.source_options(**options))


def _timeout(conf: dict[str, Any]) -> str | None:
    return conf.get("timeout", kafka.BATCH_TIMEOUT)


def _database_table(spark: SparkSession, source: dict[str, Any], name: str, condition: str) -> DataFrame:
    url, login = source["url"], source.get("login")
    split = source.get("split", {}).get(name)
    if split:
        return tables.read_split_table(spark, url, name, split["column"], split["partitions"], condition, login)
    return tables.read_table(spark, tables.table_options(url, name, condition, login=login))


@register("table.snapshot")
def table_snapshot(spark: SparkSession, conf: dict[str, Any]) -> DataFrame:
    """Tables to topics. Gives the messages, and sends them if brokers are named.

    ``database`` names a url and tables, and under ``split`` a column and number of tasks for each
    table too large for one connection.
    """
    if "tables" in conf:
        listed, condition = conf["tables"], conf.get("condition", "")
    else:
        # The database evaluates the condition, so it is not applied again here.
        source, condition = conf["database"], ""
        url, login = source["url"], source.get("login")
        frames = {name: _database_table(spark, source, name, conf.get("condition", "")) for name in source["tables"]}
        keys = tables.read_primary_keys(spark, url, login)
        listed = keyed_tables(frames, keys)
    plan = SnapshotPlan(condition=condition, tables=list(listed), **conf.get("message", {}))
    messages = plan.messages()
    if "brokers" in conf:
        kafka.write_topics(messages, kafka.sink_options(conf["brokers"], compression="lz4"))
    return messages


@register("table.changes")
def table_changes(spark: SparkSession, conf: dict[str, Any]) -> DataFrame | StreamingQuery:
    """Change log to topics. Gives the message frame, or the started query if brokers are named.

    ``relations`` describes raw changes; ``"log"`` says that the log itself does, between its changes. Messages
    of one key are sent in the order of the log. ``send`` takes the place of brokers. A bounded frame of
    ``changes`` with ``ledger`` begins where the last run ended. A stream with relations in it keeps the
    versions it has met under ``versions``.
    """
    changes = conf.get("changes")
    in_log = isinstance(conf.get("relations"), str) and conf["relations"] == "log"
    if changes is None:
        schema = LOG_WITH_RELATIONS if in_log else RAW_CHANGES if "relations" in conf else CHANGES
        changes = stream_changes(spark, conf["path"], conf.get("position"), schema, conf.get("files_per_trigger"))
    if in_log and changes.isStreaming:
        return _changes_with_relations(changes, conf)
    if in_log:
        # Versions from before the position still hold behind it.
        conf = conf | {"relations": relations_in_log(changes)}
    ledger = conf.get("ledger")
    if ledger:
        changes = since_position(changes, stored_position(spark, ledger))
    feed = ChangeFeed(**conf.get("feed", {}))
    keep = ("lsn_start",) if "brokers" in conf or "send" in conf else ()
    if "relations" in conf:
        messages = feed.raw_messages(changes, conf["relations"], keep)
    else:
        messages = feed.messages(changes, keep)
    if "send" in conf:
        ends = changes if "lsn_end" in changes.columns else changes.withColumn("lsn_end", F.expr("lsn_start + length"))
        reached = next_position(ends).first()["position"] if ledger else None
        if reached is not None:
            # Nothing above this position is sent, as the source may have grown meanwhile.
            messages = messages.where(F.col("lsn_start") < reached)
        conf["send"](in_log_order(messages))
        if reached is not None:
            spark.range(1).select(F.lit(reached).alias("position")).write.mode("append").parquet(ledger)
        return messages
    if "brokers" not in conf:
        return messages

    def send(batch: DataFrame, batch_id: int) -> None:
        to_brokers(in_log_order(batch), batch_id)

    to_brokers = _to_brokers(conf)
    writer = messages.writeStream.foreachBatch(send).option("checkpointLocation", conf["checkpoint"])
    return writer.trigger(**every(_timeout(conf))).start()


def _to_brokers(conf: dict[str, Any]) -> Callable[[DataFrame, int], None]:
    options = kafka.sink_options(conf["brokers"], timeout_ms=60_000)
    return lambda batch, batch_id: kafka.write_topics(batch, options)


def _changes_with_relations(log: DataFrame, conf: dict[str, Any]) -> StreamingQuery:
    feed, relations = ChangeFeed(**conf.get("feed", {})), RelationLog(conf["versions"])
    send = conf["send"] if "send" in conf else _to_brokers(conf)
    return start_change_stream(log, feed, relations, send, conf["checkpoint"], _timeout(conf))


def _catalog_columns(conf: dict[str, Any]) -> Callable[[], dict[str, T.StructType]]:
    def look_up() -> dict[str, T.StructType]:
        columns = conf["catalog"]() if callable(conf["catalog"]) else conf["catalog"]
        return {name: target_schema(columns, name) for name in conf["tables"]}

    return look_up


@register("table.sink")
def table_sink(spark: SparkSession, conf: dict[str, Any]) -> StreamingQuery:
    """Topics to tables.

    ``tables`` names columns by table. With ``catalog``, a frame or function of the target's columns, they
    are looked up for each batch, without those that the target fills itself; ``tables`` is then a list.
    """
    writer = conf["writer"] if "writer" in conf else jdbc_writer(**conf["database"])
    sink = TableSink(
        tables=_catalog_columns(conf) if "catalog" in conf else conf["tables"],
        ledger=Ledger(conf["ledger"]),
        write=writer,
        routes=conf.get("routes", ()),
        decoder=conf["decoder"] if "decoder" in conf else make_decoder(**conf.get("serde", {})),
        hook=conf.get("hook"),
        quarantine=conf.get("quarantine"),
        keep=tuple(conf.get("keep", ())),
    )
    return start_table_sink(_log(spark, conf), sink, conf["checkpoint"], _timeout(conf))


@register("archive.sink")
def archive_sink(spark: SparkSession, conf: dict[str, Any]) -> StreamingQuery:
    """Topics to an archive."""
    sink = ArchiveSink(conf["root"], **conf.get("archive", {}))
    return start_archive_sink(_log(spark, conf), sink, conf["checkpoint"], _timeout(conf))


@register("archive.compact")
def archive_compact(spark: SparkSession, conf: dict[str, Any]) -> DataFrame:
    """An archive with its small chunks merged, written to ``target``; then ``pointer`` names it to readers.

    What comes into the old place meanwhile is not in the new one: compact an archive that no sink writes
    to, or point the sink at the target first. Gives the manifest of the target. An archive with ``commits`` is
    compacted where it is, next to sinks that write to it.
    """
    if conf.get("commits"):
        log = ArchiveLog(conf["root"])
        log.compact(spark, **conf.get("compaction", {}))
        return archive_files.list_archive(spark, log.data, folders=log.folders(spark))
    source = archive_files.current_root(spark, conf["pointer"], conf["root"])
    archive_files.compact_archive(spark, source, conf["target"], **conf.get("compaction", {}))
    archive_files.move_pointer(spark, conf["pointer"], conf["target"])
    return archive_files.list_archive(spark, conf["target"])


@register("archive.restore")
def archive_restore(spark: SparkSession, conf: dict[str, Any]) -> DataFrame:
    """A date range of an archive to topics. Gives the records, and sends them if brokers are named.

    ``binary``, ``keep_timestamp`` and ``commits`` say how the archive was written. ``send`` takes the records in place of
    brokers. With ``ledger``, marks are loaded from there and stored once the records are sent, so that a
    job run again sends only what is new.
    """
    root = archive_files.current_root(spark, conf["pointer"], conf["root"]) if "pointer" in conf else conf["root"]
    folders = None
    if conf.get("commits"):
        log = ArchiveLog(root)
        root, folders = log.data, log.folders(spark, conf["topics"], conf["since"], conf["until"])
    where = (spark, root, conf["topics"], conf["since"], conf["until"])
    ledger, send = conf.get("ledger"), conf.get("send")
    marks = _stored_marks(spark, ledger) if ledger else conf.get("marks")
    options = {"in_order": conf.get("in_order", False), "binary": conf.get("binary", "text")}
    if conf.get("compatible"):
        restored = restore(archive_files.read_compatible(*where), marks, **options)
    else:
        restored = restore_archive(
            *where, marks, with_timestamp=conf.get("keep_timestamp", False), folders=folders, **options
        )
    if "brokers" in conf:
        sink = kafka.sink_options(conf["brokers"], compression="lz4")

        def send(records: DataFrame) -> None:
            kafka.write_topics(records, sink, keep_partition=True)

    if send is not None:
        reached = checkpointed(restored.marks) if ledger else None
        send(restored.records)
        if ledger:
            # A row per topic partition and bucket, only once its records are written.
            reached.coalesce(1).write.mode("append").parquet(ledger)
    return restored.records


def _stored_marks(spark: SparkSession, ledger: str) -> DataFrame | None:
    """Marks that earlier restores stored; None before the first."""
    try:
        stored = spark.read.schema(RESTORE_OFFSETS).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return offsets.last_offsets(stored, offsets.RESTORE_PARTITION)
