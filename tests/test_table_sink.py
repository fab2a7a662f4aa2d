import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relayframe.schemas import LOG
from relayframe.streaming import jobs
from relayframe.streaming.table_sink import (
    Ledger,
    TableSink,
    drain,
    load_batch,
    parquet_writer,
    read_table,
    start_table_sink,
)

ROW = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("note", T.StringType(), True)])


def log(spark, offsets, topic="t", partition=0):
    rows = [
        (topic, partition, o, datetime(2024, 1, 1), None, bytearray(b'{"id":%d,"note":"n%d"}' % (o, o)), [])
        for o in offsets
    ]
    return spark.createDataFrame(rows, LOG)


def make_sink(tmp_path, **options):
    base = str(tmp_path)
    tables = options.pop("tables", {"t": ROW})
    return TableSink(tables, Ledger(f"{base}/ledger"), parquet_writer(f"{base}/tables"), **options)


def stored(spark, tmp_path, table="t"):
    return sorted(r["id"] for r in read_table(spark, f"{tmp_path}/tables", table, ROW).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_replays_have_no_effect(spark, tmp_path, seed):
    """Any mix of repeats, retries and restarts stores what one delivery would."""
    rng = random.Random(seed)
    sink = make_sink(tmp_path)
    sent, batch_id, run = 0, 0, 0
    while sent < 60:
        start = rng.randrange(max(0, sent - 15), sent + 1)
        end = min(60, sent + rng.randrange(1, 20))
        batch = log(spark, range(start, end))
        for _ in range(rng.choice([1, 1, 2])):
            sink(batch, batch_id, f"run{run}")
        sent, batch_id = end, batch_id + 1
        if rng.random() < 0.3:
            run, batch_id = run + 1, 0
    assert stored(spark, tmp_path) == list(range(60))


def test_batch_wholly_below_the_mark(spark, tmp_path):
    sink = make_sink(tmp_path)
    for batch_id, offsets in enumerate([range(20), range(5), range(10, 25)]):
        sink(log(spark, offsets), batch_id, "a")
    assert stored(spark, tmp_path) == list(range(25))


def test_retry_after_a_failed_ledger_write(spark, tmp_path):
    sink = make_sink(tmp_path)
    sink(log(spark, range(10)), 0, "a")
    store, sink.ledger.store = sink.ledger.store, lambda *_: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        sink(log(spark, range(10, 20)), 1, "a")
    sink.ledger.store = store
    sink(log(spark, range(10, 20)), 1, "a")
    assert stored(spark, tmp_path) == list(range(20))


def test_missing_previous_state_falls_back_to_all(spark, tmp_path):
    sink = make_sink(tmp_path)
    load_batch(sink, log(spark, range(10)), 0, "a")
    load_batch(sink, log(spark, range(5, 15)), 7, "a")
    assert stored(spark, tmp_path) == list(range(15))


def test_topics_are_routed_and_hooked(spark, tmp_path):
    def hook(records, table):
        doubled = records.select(F.explode(F.array("offset", F.col("offset") + 100)).alias("id"))
        return doubled.withColumn("note", F.lit(table))

    sink = make_sink(tmp_path, tables={"a": ROW, "b": ROW}, routes=[("^t1$", "a"), ("^t", "b")], hook=hook)
    sink(log(spark, [1], "t1").unionByName(log(spark, [2], "t2")), 0, "r")
    assert stored(spark, tmp_path, "a") == [1, 101]
    assert stored(spark, tmp_path, "b") == [2, 102]


def test_tables_without_new_rows_get_no_files(spark, tmp_path):
    sink = make_sink(tmp_path, tables={"t": ROW, "u": ROW})
    for batch_id in range(2):
        sink(log(spark, range(5)), batch_id, "r")
    written = sorted(str(f.relative_to(tmp_path / "tables")) for f in (tmp_path / "tables").glob("*/*/*"))
    assert written == ["t/run=r/batch_id=0"]


def test_topic_without_a_table_fails(spark, tmp_path):
    with pytest.raises(Exception, match="the target lists no columns of x"):
        make_sink(tmp_path)(log(spark, [1], "x"), 0, "r")


def test_stream_equals_batch_and_survives_a_new_checkpoint(spark, tmp_path):
    source = str(tmp_path / "log")
    sink = make_sink(tmp_path)
    for offsets in (range(20), range(10, 40)):
        log(spark, offsets).write.mode("append").parquet(source)
        stream = spark.readStream.schema(LOG).parquet(source)
        drain([start_table_sink(stream, sink, str(tmp_path / "checkpoint"), timeout=None)])
    assert stored(spark, tmp_path) == list(range(40))
    # All of it again from a lost checkpoint.
    stream = spark.readStream.schema(LOG).parquet(source)
    drain([start_table_sink(stream, sink, str(tmp_path / "other"), timeout=None)])
    assert stored(spark, tmp_path) == list(range(40))


def test_malformed_record_stops_the_stream(spark, tmp_path):
    bad = log(spark, [1]).withColumn("value", F.lit("{").cast("binary"))
    bad.write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(LOG).parquet(str(tmp_path / "log"))
    query = start_table_sink(stream, make_sink(tmp_path), str(tmp_path / "checkpoint"), timeout=None)
    with pytest.raises(Exception, match="(?i)malformed"):
        drain([query])


def test_quarantine(spark, tmp_path):
    bad = log(spark, [1, 3]).withColumn("value", F.lit("{").cast("binary"))
    sink = make_sink(tmp_path, quarantine=parquet_writer(str(tmp_path / "bad")))
    for _ in range(2):
        sink(log(spark, [0, 2]).unionByName(bad), 0, "r")
    assert stored(spark, tmp_path) == [0, 2]
    kept = read_table(spark, str(tmp_path / "bad"), "t", LOG)
    assert sorted((r["offset"], bytes(r["value"])) for r in kept.collect()) == [(1, b"{"), (3, b"{")]


def test_jobs_by_name(spark, tmp_path):
    log(spark, range(30)).write.parquet(str(tmp_path / "log"))

    def stream():
        return spark.readStream.schema(LOG).parquet(str(tmp_path / "log"))

    archived = jobs.run(
        spark,
        "archive.sink",
        {"log": stream(), "root": str(tmp_path / "a"), "checkpoint": str(tmp_path / "c1"), "timeout": None, "archive": {"interval": "24h"}},
    )
    loaded = jobs.run(
        spark,
        "table.sink",
        {
            "log": stream(),
            "tables": {"t": ROW},
            "ledger": str(tmp_path / "ledger"),
            "writer": parquet_writer(str(tmp_path / "tables")),
            "checkpoint": str(tmp_path / "c2"),
            "timeout": None,
            "serde": {"fmt": "json", "time_format": "rfc3339"},
        },
    )
    drain([archived, loaded])
    assert stored(spark, tmp_path) == list(range(30))
    records = jobs.run(
        spark,
        "archive.restore",
        {"root": str(tmp_path / "a"), "topics": ["t"], "since": "2024-01-01 00:00:00", "until": "2024-01-01 00:00:00"},
    )
    assert records.count() == 30
    with pytest.raises(ValueError, match="unknown job class"):
        jobs.get("nothing")


def test_a_quarantine_refuses_other_decoders(tmp_path):
    with pytest.raises(ValueError, match="quarantine"):
        make_sink(tmp_path, quarantine=parquet_writer(str(tmp_path / "bad")), decoder=lambda value, target: value)
