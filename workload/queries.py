"""The registered queries: every operator over the given tables, whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relayframe.functions import codecs, payload, text, times
from relayframe.operators import archive, catalog, changes, compaction, decode, envelope, offsets, routing
from relayframe.plans.changefeed import ChangeFeed
from relayframe.plans.restore import restore, restore_archive
from relayframe.plans.snapshot import SnapshotPlan, SnapshotTable
from relayframe.session import scratch_path, share_package, tasks_for, use_utc
from relayframe.sources import archive_files, changelog
from relayframe.sources.archive_commits import ArchiveLog
from relayframe.streaming import jobs
from relayframe.streaming.archive_sink import ArchiveSink, start_archive_sink
from relayframe.streaming.table_sink import (
    Ledger,
    TableSink,
    drain,
    load_batch,
    parquet_writer,
    read_table,
    start_table_sink,
)
from workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

ORDER_ROUTES = [(r"^public\.orders_[0-9]$", "public.orders")]
EVENT_ROUTES = [(r"events\.(click|view)", "engagement"), (r"events\..*", "other")]
TOPIC_ROUTES = [
    (r"^public\.(click|view)_\d$", "cdc.engagement"),
    (r"^public\.error_[0-2]$", "errors"),
    (r"^public\.", "public.rest"),
]
RESTORE_SINCE, RESTORE_UNTIL = "2024-01-08 00:00:00", "2024-01-21 12:00:00"


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(share_package(use_utc(spark)), sf_dir)

    _QUERIES[function.__name__] = run
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _as_text(log: DataFrame, *extra: str | Column) -> DataFrame:
    """Records with their bytes shown as text."""
    return log.select(
        *extra,
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        payload.headers_text(F.col("headers")).alias("headers"),
    )


# -- tables to messages ----------------------------------------------------------------------


@query
def log_shape(spark, sf_dir):
    return _as_text(
        fx.log(spark, sf_dir), "topic", "partition", "offset", F.unix_millis("timestamp").alias("ts_ms")
    )


@query
def snapshot_scan(spark, sf_dir):
    orders = fx.read(spark, sf_dir, "orders")
    rows = envelope.with_total(envelope.snapshot_rows(orders, "WHERE o_totalprice > 1000"))
    return codecs.canonical_row(rows)


@query
def snapshot_count(spark, sf_dir):
    return envelope.row_count(fx.read(spark, sf_dir, "lineitem"), "WHERE l_quantity > 10")


def _with_decimal(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.col(name).cast("decimal(18,2)"))


@query
def snapshot_envelope(spark, sf_dir):
    orders = _with_decimal(fx.read(spark, sf_dir, "orders"), "o_totalprice")
    plan = SnapshotPlan(
        condition="WHERE o_totalprice > 1000",
        prefix="cdc",
        host="db",
        port=5432,
        database="shop",
        ts_ms=fx.TS_MS,
        tables=[SnapshotTable("public.orders", orders, ["o_orderkey"])],
    )
    return _as_text(plan.messages(), "topic")


@query
def snapshot_multi_table(spark, sf_dir):
    customers = _with_decimal(fx.read(spark, sf_dir, "customer"), "c_acctbal")
    plan = SnapshotPlan(
        routes=[(r"^public\.region$", "reference")],
        total=False,
        ts_ms=fx.TS_MS,
        tables=[
            SnapshotTable("public.customer", customers, ["c_custkey"]),
            SnapshotTable("public.region", fx.read(spark, sf_dir, "region")),
            SnapshotTable("public.nation", fx.read(spark, sf_dir, "nation"), ["n_nationkey", "n_regionkey"]),
        ],
    )
    return _as_text(plan.messages(), "topic")


@query
def canonical_types(spark, sf_dir):
    orders = fx.read(spark, sf_dir, "orders")
    when = F.col("o_orderdate").cast("timestamp")
    typed = orders.select(
        "o_orderkey",
        F.unhex(F.md5(F.col("o_orderkey").cast("string"))).alias("id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        "o_orderdate",
        F.to_date("o_orderdate").alias("day"),
        F.timestamp_millis(F.unix_millis(when) + F.col("o_orderkey") % 1000).alias("zoned"),
    )
    return codecs.canonical_row(typed, zoned=["zoned"], uuids=["id"])


@query
def pk_lookup(spark, sf_dir):
    return catalog.primary_keys(*fx.catalog(spark, sf_dir))


@query
def table_name_split(spark, sf_dir):
    constraints, _ = fx.catalog(spark, sf_dir)
    full = constraints.select(text.qualify(F.col("table_schema"), F.col("table_name")).alias("full_name"))
    return full.select("full_name", text.split_qualified(F.col("full_name")).alias("parts")).select(
        "full_name", F.col("parts.schema").alias("schema_name"), F.col("parts.table").alias("table_name")
    )


# -- row changes -----------------------------------------------------------------------------


def _changes(spark, sf_dir):
    return changes.describe(fx.raw_changes(spark, sf_dir), fx.relations(spark))


@query
def change_describe(spark, sf_dir):
    return _changes(spark, sf_dir).select(
        "lsn_start",
        "lsn_end",
        "op",
        "relation",
        F.array_join(F.transform("cols", lambda c: F.concat(c["name"], F.lit(":"), c["kind"])), ",").alias("cells"),
    )


@query
def change_filter(spark, sf_dir):
    feed = ChangeFeed(tables=["public.orders_0", "public.orders_2", "public.pipe_health"], skip_deletes=True)
    return feed.selected(_changes(spark, sf_dir)).select("lsn_start", "op", "relation")


@query
def change_decode(spark, sf_dir):
    rows = changes.row_changes(_changes(spark, sf_dir))
    return rows.select(
        "lsn_start",
        changes.key_json(F.col("cols")).alias("key"),
        changes.tuple_json(F.col("cols")).alias("value"),
        changes.tuple_json(F.col("cols"), unchanged="omit").alias("value_sent"),
    )


@query
def change_messages(spark, sf_dir):
    feed = ChangeFeed(
        routes=ORDER_ROUTES, prefix="cdc", host="db", port=5432, database="shop", ts_ms=fx.TS_MS
    )
    return _as_text(feed.messages(_changes(spark, sf_dir)), "topic")


@query
def change_messages_known(spark, sf_dir):
    """The same messages from raw changes, with the relations' columns spelled out."""
    feed = ChangeFeed(
        routes=ORDER_ROUTES, prefix="cdc", host="db", port=5432, database="shop", ts_ms=fx.TS_MS
    )
    return _as_text(feed.raw_messages(fx.raw_changes(spark, sf_dir), fx.relations(spark)), "topic")


def _plain_feed() -> ChangeFeed:
    return ChangeFeed(ts_ms=fx.TS_MS)


def _values(messages: DataFrame) -> DataFrame:
    return messages.select("lsn_start", "topic", F.col("value").cast("string").alias("value"))


@query
def change_binary(spark, sf_dir):
    """Orders as changes whose cells are in text and binary format by turns."""
    raw, relations = fx.binary_changes(spark, sf_dir)
    return _values(_plain_feed().raw_messages(raw, relations, keep=("lsn_start",)))


@query
def change_relation_altered(spark, sf_dir):
    """A table that loses a column and takes it back while its changes are logged."""
    raw, relations = fx.altered_changes(spark, sf_dir)
    return _values(_plain_feed().raw_messages(raw, relations, keep=("lsn_start",)))


@query
def change_wide(spark, sf_dir):
    """The changes next to relations of 5,000 columns, which are looked up in one scan."""
    raw, relations = fx.binary_changes(spark, sf_dir)
    return _values(_plain_feed().raw_messages(raw, relations.unionByName(fx.wide_relations(spark)), keep=("lsn_start",)))


@query
def change_stream_altered(spark, sf_dir):
    """A log with relations in it, read as a stream of three batches; the second alters the table within."""
    log = fx.log_with_relations(spark, sf_dir)
    base = scratch_path(spark, "change-stream")
    conf = {
        "path": f"{base}/log",
        "relations": "log",
        "versions": f"{base}/versions",
        "feed": {"ts_ms": fx.TS_MS},
        "checkpoint": f"{base}/checkpoint",
        "timeout": None,
        "send": lambda messages, batch_id: messages.write.parquet(f"{base}/sent/batch={batch_id}"),
    }
    # A batch is what came since the last run, in as many files of the log as its rows need tasks.
    for low, high in ((0, 10_000), (10_000, 50_000), (50_000, 2**62)):
        part = log.where(F.col("lsn_start").between(low, high - 1))
        tasks = tasks_for(spark, part.count())
        part.repartitionByRange(tasks, "lsn_start").write.mode("append").parquet(f"{base}/log")
        drain([jobs.run(spark, "table.changes", conf)])
    return _values(spark.read.parquet(f"{base}/sent"))


@query
def change_looked_up(spark, sf_dir):
    """The altered table's changes, with its relations looked up for each change."""
    raw, relations = fx.altered_changes(spark, sf_dir)
    return _values(_plain_feed().looked_up_messages(raw, relations, keep=("lsn_start",)))


@query
def change_position(spark, sf_dir):
    return changes.next_position(_changes(spark, sf_dir))


@query
def change_log_read(spark, sf_dir):
    """The change log as files, read as a stream from a position."""
    path = scratch_path(spark, "changes")
    _changes(spark, sf_dir).write.parquet(path)
    stream = changes.row_changes(changelog.stream_changes(spark, path, position=5_000))
    out = scratch_path(spark, "changes-out")
    sent = (
        stream.select("lsn_start", "lsn_end", "op", "relation")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_path(spark, "changes-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    drain([sent])
    return spark.read.schema("lsn_start bigint, lsn_end bigint, op string, relation string").parquet(out)


# -- routing ---------------------------------------------------------------------------------


@query
def route_topic(spark, sf_dir):
    events = fx.read(spark, sf_dir, "events")
    relation = text.qualify(
        F.lit("public"), F.concat("event_type", F.lit("_"), (F.col("user_id") % 5).cast("string"))
    )
    return events.select(
        "event_id",
        routing.route_topic(relation, TOPIC_ROUTES).alias("topic"),
        routing.route_topic(relation, TOPIC_ROUTES, "cdc").alias("prefixed_topic"),
    )


@query
def route_table(spark, sf_dir):
    return fx.log(spark, sf_dir).select(
        "offset",
        routing.route_table(F.col("topic"), EVENT_ROUTES).alias("target"),
        routing.route_table(F.col("topic"), EVENT_ROUTES[:1]).alias("target_or_topic"),
    )


# -- decoding --------------------------------------------------------------------------------


def _ts_ms(name: str = "ts") -> Column:
    return F.unix_millis(name).alias(f"{name}_ms")


@query
def json_decode(spark, sf_dir):
    return decode.project(fx.log(spark, sf_dir), fx.EVENT_TARGET).select(
        "event_id", "user_id", "event_type", _ts_ms()
    )


@query
def json_zero_fill(spark, sf_dir):
    target = catalog.target_schema(fx.target_columns(spark), "events")
    rows = decode.project(fx.log(spark, sf_dir), target, keep=("topic",))
    return rows.withColumn("ts", F.unix_millis("ts")).withColumnRenamed("ts", "ts_ms")


@query
def json_time_formats(spark, sf_dir):
    events = fx.log(spark, sf_dir).select("offset", F.col("timestamp").alias("t"))
    target = T.StructType([T.StructField("t", T.TimestampType(), False)])
    texts = {
        times.RFC3339: F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"),
        times.SECONDS: F.unix_seconds("t"),
        times.MILLIS: F.unix_millis("t"),
    }
    messages = {fmt: F.to_json(F.struct(v.alias("t"))) for fmt, v in texts.items()}
    decoded = [
        F.unix_millis(decode.zero_filled(decode.json_decoder(fmt)(m.cast("binary"), target), target)[0]).alias(name)
        for (fmt, m), name in zip(messages.items(), ["rfc3339_ms", "seconds_ms", "milli_ms"])
    ]
    return events.select("offset", *decoded)


@query
def json_bytes(spark, sf_dir):
    """Text, objects with keys in any order and numbers as written, numbers, and nulls in a bytes column."""
    events = fx.read(spark, sf_dir, "events")
    kind = F.col("event_id") % 4
    odd = F.concat(F.lit('{"z": '), F.col("user_id"), F.lit(', "a":1.50,  "m":1e3, "k": ['), F.col("event_id"), F.lit(", 0.0]}"))
    field = (
        F.when(kind == 0, F.concat(F.lit('"'), F.base64(F.col("props").cast("binary")), F.lit('"')))
        .when(kind == 1, odd)
        .when(kind == 2, F.concat(F.col("user_id").cast("string"), F.lit(".00")))
        .otherwise(F.lit("null"))
    )
    message = F.concat(F.lit('{"b":'), field, F.lit("}")).cast("binary")
    target = T.StructType([T.StructField("b", T.BinaryType(), True)])
    return events.select("event_id", decode.json_decoder()(message, target)["b"].cast("string").alias("b"))


@query
def json_dates(spark, sf_dir):
    """Date columns in the three time formats."""
    orders = fx.read(spark, sf_dir, "orders")
    day = F.date_trunc("day", F.col("o_orderdate").cast("timestamp"))
    target = T.StructType([T.StructField("d", T.DateType(), False)])
    texts = {
        times.RFC3339: F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        times.SECONDS: F.unix_seconds(day),
        times.MILLIS: F.unix_millis(day),
    }
    decoded = [
        decode.zero_filled(decode.json_decoder(fmt)(F.to_json(F.struct(v.alias("d"))).cast("binary"), target), target)[0]
        .cast("string")
        .alias(name)
        for (fmt, v), name in zip(texts.items(), ["rfc3339_day", "seconds_day", "milli_day"])
    ]
    return orders.select("o_orderkey", *decoded)


@query
def json_quarantine(spark, sf_dir):
    """One record in ten is cut short; it is set aside and the others are decoded."""
    value = F.when(F.col("offset") % 10 == 0, F.substring(F.col("value").cast("string"), 1, 20).cast("binary"))
    log = fx.log(spark, sf_dir).withColumn("value", F.coalesce(value, F.col("value")))
    good, bad = decode.split_malformed(log, fx.EVENT_TARGET, keep=("topic", "offset"))
    return good.select("topic", "offset", "user_id", F.lit(False).alias("malformed")).unionByName(
        bad.select("topic", "offset", F.lit(None).cast("bigint").alias("user_id"), F.lit(True).alias("malformed"))
    )


@query
def hook_transform(spark, sf_dir):
    """A table sink whose hook filters, reshapes and multiplies rows."""

    def hook(records: DataFrame, table: str) -> DataFrame:
        rows = decode.project(records, fx.EVENT_TARGET).where("event_type != 'view'")
        return rows.select(
            "event_id", F.explode(F.array(F.lit("first"), F.upper("event_type"))).alias("label")
        )

    base = scratch_path(spark, "sink")
    sink = TableSink({"events": fx.EVENT_TARGET}, Ledger(f"{base}/ledger"), parquet_writer(base), [(".*", "events")], hook=hook)
    load_batch(sink, fx.log(spark, sf_dir), 0, "a")
    return read_table(spark, base, "events", T.StructType.fromDDL("event_id bigint, label string"))


# -- offsets ---------------------------------------------------------------------------------


@query
def replay_filter(spark, sf_dir):
    log = fx.log(spark, sf_dir)
    return offsets.fresh_records(log, fx.marks(log)).select("topic", "partition", "offset")


@query
def replay_resume(spark, sf_dir):
    """Where each partition goes on. The log has gaps in every partition, so this is the first
    offset there is above the mark, not the mark plus one."""
    log = fx.log(spark, sf_dir)
    fresh = offsets.fresh_records(log, fx.marks(log))
    return fresh.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"), F.count(F.lit(1)).alias("n_rows")
    )


@query
def skipped_ranges(spark, sf_dir):
    log = fx.log(spark, sf_dir)
    return offsets.skipped_ranges(log, fx.marks(log))


@query
def offset_state(spark, sf_dir):
    """Marks after a batch that in some partitions lies wholly below the stored mark."""
    log = fx.log(spark, sf_dir)
    stored = fx.marks(log).withColumn("offset", F.col("offset") * (F.col("partition") + 1))
    return offsets.merge_offsets(stored, log)


@query
def topics_distinct(spark, sf_dir):
    return offsets.topics_of(fx.log(spark, sf_dir))


@query
def batch_sizes(spark, sf_dir):
    log = fx.log(spark, sf_dir)
    return offsets.batch_sizes(log, F.call_function("div", F.col("offset"), F.lit(10_000)))


# -- archive ---------------------------------------------------------------------------------


@query
def archive_chunks(spark, sf_dir):
    return archive.chunk_stats(fx.log(spark, sf_dir), "1h")


@query
def archive_chunks_7h(spark, sf_dir):
    return archive.chunk_stats(fx.log(spark, sf_dir), "7h")


@query
def archive_chunks_7d(spark, sf_dir):
    return archive.chunk_stats(fx.log(spark, sf_dir), fx.WEEK)


@query
def archive_chunks_subsecond(spark, sf_dir):
    """Buckets of 250 ms share the text of their second."""
    return archive.chunk_stats(fx.log(spark, sf_dir), "250ms").groupBy("topic").agg(
        F.count(F.lit(1)).alias("n_chunks"), F.min("bucket").alias("first_bucket"), F.max("bucket").alias("last_bucket")
    )


@query
def archive_rows(spark, sf_dir):
    rows = archive.to_archive_rows(fx.log(spark, sf_dir))
    return rows.withColumn("headers", payload.headers_text(F.col("headers")))


@query
def archive_prev_chunk(spark, sf_dir):
    chunks = archive.chunk_stats(fx.log(spark, sf_dir), fx.WEEK, fx.MANIFEST_CHUNK)
    return archive.with_previous_chunk(chunks)


@query
def chunk_paths(spark, sf_dir):
    """Chunk paths built from a manifest and parsed back."""
    chunks = archive.chunk_stats(fx.log(spark, sf_dir), "1h")
    path = F.concat_ws(
        "/",
        F.lit("file:/archive"),
        "topic",
        F.replace("bucket", F.lit(" "), F.lit("%20")),
        F.col("partition").cast("string"),
        F.concat(archive.chunk_name(F.col("min_offset"), F.col("max_offset")), F.lit(".gz")),
    )
    return chunks.select(path.alias("path")).select(
        "path", archive.parse_chunk_path(F.col("path")).alias("chunk")
    ).select("path", "chunk.*")


@query
def compaction_plan(spark, sf_dir):
    return compaction.compaction_plan(fx.manifest(spark, sf_dir))


@query
def compaction_stale(spark, sf_dir):
    """A manifest in which every chunk was also delivered in part once more."""
    chunks = fx.manifest(spark, sf_dir)
    middle = F.call_function("div", F.col("min_offset") + F.col("max_offset"), F.lit(2))
    again = chunks.withColumns({"min_offset": middle, "size_bytes": F.lit(500_000).cast("bigint")})
    labels = compaction.label_chunks(chunks.unionByName(again))
    return labels.groupBy("topic", "bucket", "partition").agg(
        F.count_if("stale").alias("n_stale"),
        F.count_if(~F.col("stale")).alias("n_kept"),
        F.count_distinct(F.when(~F.col("stale"), F.col("group_id"))).alias("n_groups"),
    )


def _restorable(spark, sf_dir):
    rows = archive.to_archive_rows(fx.log(spark, sf_dir), "12h")
    return archive.of_topics(
        archive.in_buckets(rows, RESTORE_SINCE, RESTORE_UNTIL), ["events.click", "events.error", "events.view"]
    )


@query
def restore_range(spark, sf_dir):
    rows = _restorable(spark, sf_dir)
    records = restore(rows, fx.restore_marks(rows)).records
    return _as_text(records, "topic", "partition", "offset")


@query
def restore_counters(spark, sf_dir):
    """Counters of an archive that holds every record twice."""
    rows = _restorable(spark, sf_dir)
    return restore(rows.unionAll(rows), fx.restore_marks(rows)).counters


@query
def restore_marks(spark, sf_dir):
    rows = _restorable(spark, sf_dir)
    return restore(rows, fx.restore_marks(rows)).marks


@query
def archive_round_trip(spark, sf_dir):
    """Log to archive files and back."""
    root = scratch_path(spark, "archive")
    ArchiveSink(root, interval=fx.WEEK, replace=False)(fx.log(spark, sf_dir))
    records = restore_archive(spark, root).records
    return _as_text(records, "topic", "partition", "offset")


@query
def archive_manifest(spark, sf_dir):
    root = scratch_path(spark, "archive")
    ArchiveSink(root, interval=fx.WEEK, replace=False)(fx.log(spark, sf_dir))
    listed = archive_files.list_archive(spark, root)
    return listed.groupBy("topic", "bucket", "partition").agg(
        F.min("min_offset").alias("min_offset"),
        F.max("max_offset").alias("max_offset"),
        F.sum("n_rows").alias("n_rows"),
        (F.min("size_bytes") > 0).alias("has_size"),
    )


@query
def archive_compatible(spark, sf_dir):
    """Log to an archive of the compatible layout and back."""
    log = fx.log(spark, sf_dir)
    # A path without a scheme is a local one.
    root = scratch_path(spark, "archive")
    archive_files.write_compatible(archive.to_archive_rows(log, fx.WEEK), root if ":" in root else f"file://{root}")
    topics = [row["topic"] for row in offsets.topics_of(log).collect()]
    records = restore(archive_files.read_compatible(spark, root, topics)).records
    return _as_text(records, "topic", "partition", "offset")


def _two_thirds(log: DataFrame, rest: bool = False) -> DataFrame:
    bound = log.agg(F.call_function("div", F.max("offset") * 2, F.lit(3))).scalar()
    return log.where(F.col("offset") > bound if rest else F.col("offset") <= bound)


@query
def archive_compacted(spark, sf_dir):
    """An archive to which two thirds of the log, then all of it, were delivered, with its chunks merged."""
    log = fx.log(spark, sf_dir)
    source, target = scratch_path(spark, "archive"), scratch_path(spark, "compacted")
    sink = ArchiveSink(source, interval=fx.WEEK, replace=False)
    for delivery in [_two_thirds(log), log]:
        sink(delivery)
    archive_files.compact_archive(spark, source, target)
    rows = archive_files.read_archive(spark, target)
    return rows.groupBy("topic", "bucket", "partition").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("offset").alias("offset_sum")
    )


# -- streams ---------------------------------------------------------------------------------


@query
def table_sink_replay(spark, sf_dir):
    """A log delivered as a stream, two thirds of it twice; the tables hold every record once."""
    log = fx.log(spark, sf_dir)
    source, base = scratch_path(spark, "log"), scratch_path(spark, "sink")
    tables = {"engagement": fx.EVENT_TARGET, "other": fx.EVENT_TARGET}
    sink = TableSink(
        tables, Ledger(f"{base}/ledger"), parquet_writer(f"{base}/tables"), EVENT_ROUTES, keep=("topic", "partition", "offset")
    )
    for delivery in [_two_thirds(log), log]:
        delivery.write.mode("append").parquet(source)
        stream = spark.readStream.schema(log.schema).parquet(source)
        drain([start_table_sink(stream, sink, f"{base}/checkpoint", timeout=None)])
    stored = T.StructType(
        [*[log.schema[c] for c in ("topic", "partition", "offset")], *fx.EVENT_TARGET.fields]
    )
    written = [
        read_table(spark, f"{base}/tables", name, stored).withColumn("target", F.lit(name)) for name in tables
    ]
    return written[0].unionByName(written[1]).withColumn("ts", F.unix_millis("ts")).withColumnRenamed("ts", "ts_ms")


@query
def table_sink_retry(spark, sf_dir):
    """Batches of a bounded log, one run again as after a failure and one replayed by a new run."""
    log = fx.log(spark, sf_dir)
    base = scratch_path(spark, "sink")
    sink = TableSink({"other": fx.EVENT_TARGET}, Ledger(f"{base}/ledger"), parquet_writer(base), [(".*", "other")])
    first = _two_thirds(log)
    for batch, batch_id, run in [(first, 0, "a"), (log, 1, "a"), (log, 1, "a"), (first, 0, "b")]:
        load_batch(sink, batch, batch_id, run)
    rows = read_table(spark, base, "other", fx.EVENT_TARGET)
    return rows.select("event_id", "user_id", "event_type", _ts_ms())


@query
def table_sink_repeat_in_batch(spark, sf_dir):
    """One batch that holds two deliveries."""
    log = fx.log(spark, sf_dir)
    base = scratch_path(spark, "sink")
    sink = TableSink({"other": fx.EVENT_TARGET}, Ledger(f"{base}/ledger"), parquet_writer(base), [(".*", "other")])
    load_batch(sink, _two_thirds(log).unionAll(log), 0, "a")
    rows = read_table(spark, base, "other", fx.EVENT_TARGET)
    return rows.select("event_id", "user_id", "event_type", _ts_ms())


@query
def table_sink_catalog(spark, sf_dir):
    """The sink job by name, with a decoder of its own, columns from the target's catalog, defaulted ones left out."""
    log = fx.log(spark, sf_dir)
    source, base = scratch_path(spark, "log"), scratch_path(spark, "sink")
    log.write.parquet(source)
    catalog_frame = fx.target_columns(spark)
    conf = {
        "log": spark.readStream.schema(log.schema).parquet(source),
        "tables": ["events"],
        "catalog": lambda: catalog_frame,
        "ledger": f"{base}/ledger",
        "writer": parquet_writer(base),
        "routes": [(".*", "events")],
        "decoder": decode.json_decoder(times.MILLIS),
        "checkpoint": f"{base}/checkpoint",
        "timeout": None,
    }
    drain([jobs.run(spark, "table.sink", conf)])
    target = catalog.target_schema(catalog_frame, "events")
    rows = read_table(spark, base, "events", target)
    return rows.withColumn("ts", F.unix_millis("ts")).withColumnRenamed("ts", "ts_ms")


@query
def archive_compatible_redelivery(spark, sf_dir):
    """Two gapped deliveries that share every chunk's bounds, written to the compatible layout."""
    log = fx.log(spark, sf_dir)
    root = scratch_path(spark, "archive")
    root = root if ":" in root else f"file://{root}"
    rows = archive.to_archive_rows(log, fx.WEEK)
    for inner in (F.col("offset") % 2 == 0, F.col("offset") % 2 == 1):
        part = fx.with_ends(rows, inner)
        archive_files.write_compatible(part, root, chunk_offsets=1 << 40)
    topics = [row["topic"] for row in offsets.topics_of(log).collect()]
    records = restore(archive_files.read_compatible(spark, root, topics)).records
    return _as_text(records, "topic", "partition", "offset")


@query
def archive_base64_restore(spark, sf_dir):
    """An archive of base64 values with nulls and timestamps, restored by the job."""
    root = scratch_path(spark, "archive")
    ArchiveSink(root, interval=fx.WEEK, replace=False, binary="base64", keep_nulls=True, keep_timestamp=True)(fx.log(spark, sf_dir))
    conf = {"root": root, "topics": None, "since": None, "until": None, "binary": "base64", "keep_timestamp": True}
    records = jobs.run(spark, "archive.restore", conf)
    return _as_text(records, "topic", "partition", "offset", F.unix_millis("timestamp").alias("ts_ms")).drop("headers")


@query
def archive_compacted_timestamps(spark, sf_dir):
    """Compaction of an archive that keeps timestamps."""
    log = fx.log(spark, sf_dir)
    source, target = scratch_path(spark, "archive"), scratch_path(spark, "compacted")
    sink = ArchiveSink(source, interval=fx.WEEK, replace=False, keep_timestamp=True)
    for delivery in [_two_thirds(log), log]:
        sink(delivery)
    archive_files.compact_archive(spark, source, target)
    records = restore_archive(spark, target, with_timestamp=True).records
    return _as_text(records, "topic", "partition", "offset", F.unix_millis("timestamp").alias("ts_ms")).drop("headers")


@query
def archive_compact_job(spark, sf_dir):
    """Compaction by name, then a restore by name that finds the compacted archive through the pointer."""
    log = fx.log(spark, sf_dir)
    base = scratch_path(spark, "compact")
    conf = {"root": f"{base}/archive", "target": f"{base}/compacted", "pointer": f"{base}/current"}
    sink = ArchiveSink(conf["root"], interval=fx.WEEK, replace=False)
    for delivery in [_two_thirds(log), log]:
        sink(delivery)
    jobs.run(spark, "archive.compact", conf)
    conf |= {"topics": None, "since": None, "until": None}
    return _as_text(jobs.run(spark, "archive.restore", conf), "topic", "partition", "offset")


@query
def archive_committed(spark, sf_dir):
    """A committed archive: a batch delivered twice, an attempt that was never committed, a compaction, a later
    batch that overlaps; then a restore."""
    log, week = fx.log(spark, sf_dir), fx.WEEK
    archive_log = ArchiveLog(scratch_path(spark, "archive"))
    sink = ArchiveSink(archive_log.root, interval=week, commits=True)
    for batch_id, delivery in enumerate([_two_thirds(log), _two_thirds(log)]):
        sink(delivery, batch_id // 2, "events")
    lost = archive.by_offset_range(archive.to_archive_rows(log, week))
    archive_files.write_attempt(lost, f"{archive_log.data}/attempt=lost")
    archive_log.compact(spark)
    sink(log, 1, "events")
    restored = restore_archive(spark, archive_log.data, folders=archive_log.folders(spark))
    return _as_text(restored.records, "topic", "partition", "offset")


@query
def archive_committed_range(spark, sf_dir):
    """Chunks of a date range: only folders of commits that reach into it are listed."""
    log = fx.log(spark, sf_dir)
    archive_log = ArchiveLog(scratch_path(spark, "archive"))
    sink = ArchiveSink(archive_log.root, interval="12h", commits=True)
    for batch_id, rest in enumerate([False, True]):
        sink(_two_thirds(log, rest), batch_id, "events")
    folders = archive_log.folders(spark, None, RESTORE_SINCE, RESTORE_UNTIL)
    listed = archive_files.list_archive(spark, archive_log.data, None, RESTORE_SINCE, RESTORE_UNTIL, folders)
    return listed.groupBy("topic", "bucket", "partition").agg(
        F.min("min_offset").alias("min_offset"), F.max("max_offset").alias("max_offset"), F.sum("n_rows").alias("n_rows")
    )


@query
def restore_resumed(spark, sf_dir):
    """The restore job run after each of two deliveries; every record is sent once."""
    log = fx.log(spark, sf_dir)
    base = scratch_path(spark, "restore")
    sink = ArchiveSink(f"{base}/archive", interval=fx.WEEK, replace=False)
    conf = {
        "root": f"{base}/archive",
        "topics": None,
        "since": None,
        "until": None,
        "ledger": f"{base}/ledger",
        "send": lambda records: records.write.mode("append").parquet(f"{base}/sent"),
    }
    for delivery in [_two_thirds(log), log]:
        sink(delivery)
        jobs.run(spark, "archive.restore", conf)
    return _as_text(spark.read.parquet(f"{base}/sent"), "topic", "partition", "offset")


@query
def changes_resumed(spark, sf_dir):
    """The change job run on a log that grows between runs, and once more when it has not."""
    raw, relations = fx.binary_changes(spark, sf_dir)
    base = scratch_path(spark, "changes")
    bound = raw.agg(F.call_function("div", F.max("lsn_start"), F.lit(2))).scalar()
    for changes_so_far in (raw.where(F.col("lsn_start") < bound), raw, raw):
        conf = {
            "changes": changes_so_far,
            "relations": relations,
            "feed": {"ts_ms": fx.TS_MS},
            "ledger": f"{base}/ledger",
            "send": lambda messages: messages.write.mode("append").parquet(f"{base}/sent"),
        }
        jobs.run(spark, "table.changes", conf)
    return _values(spark.read.parquet(f"{base}/sent"))


@query
def stream_archive(spark, sf_dir):
    """Events read as a stream and archived."""
    events = fx.read(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    root = scratch_path(spark, "archive")
    sink = ArchiveSink(root, interval=fx.WEEK)
    drain([start_archive_sink(fx.event_log(stream), sink, scratch_path(spark, "checkpoint"), timeout=None)])
    return archive_files.read_archive(spark, root).select(
        "topic", "bucket", "partition", "offset", "key", "value"
    )
