import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relayframe.operators import catalog, envelope
from relayframe.plans.snapshot import SnapshotPlan, SnapshotTable, keyed_tables
from relayframe.sources import kafka, tables
from relayframe.streaming import jobs
from relayframe.streaming.triggers import every

CONSTRAINTS = "constraint_schema string, constraint_name string, constraint_type string, table_schema string, table_name string"
USAGE = "constraint_schema string, constraint_name string, column_name string"


@pytest.fixture
def key_columns(spark):
    constraints = [
        ("a", "pk", "PRIMARY KEY", "a", "t"),
        ("b", "pk", "PRIMARY KEY", "b", "t"),
        ("a", "fk", "FOREIGN KEY", "a", "t"),
    ]
    usage = [("a", "pk", "id"), ("b", "pk", "x"), ("b", "pk", "y"), ("a", "fk", "other")]
    return catalog.primary_keys(spark.createDataFrame(constraints, CONSTRAINTS), spark.createDataFrame(usage, USAGE))


def test_constraint_names_do_not_mix_schemas(key_columns):
    assert catalog.key_columns_of(key_columns, "a", "t") == ["id"]
    assert sorted(catalog.key_columns_of(key_columns, "b", "t")) == ["x", "y"]
    assert catalog.key_columns_of(key_columns, "a", "none") == []


def test_target_schema_leaves_out_defaults(spark):
    columns = spark.createDataFrame(
        [("t", "a", "bigint", False, ""), ("t", "b", "timestamp", False, "now()"), ("t", "c", "array<string>", True, None)],
        "table string, name string, type string, nullable boolean, default_expression string",
    )
    target = catalog.target_schema(columns, "t")
    assert [(f.name, f.dataType, f.nullable) for f in target] == [
        ("a", T.LongType(), False),
        ("c", T.ArrayType(T.StringType()), True),
    ]
    with pytest.raises(ValueError):
        catalog.target_schema(columns, "u")


def test_conditions(spark):
    df = spark.range(10)
    for condition in ("WHERE id > 6", "  where id > 6 ", "id > 6"):
        assert envelope.row_count(df, condition).first()["n_rows"] == 3
    assert envelope.strip_where("whereabouts = 1") == "whereabouts = 1"
    assert envelope.row_count(df).first()["n_rows"] == 10


def test_total_replaces_a_column_and_needs_no_single_task(spark):
    df = spark.range(10).withColumn("total", F.lit("own"))
    rows = envelope.with_total(df)
    assert {r["total"] for r in rows.collect()} == {10}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_messages_of_several_tables(spark, key_columns):
    frames = {"a.t": spark.createDataFrame([(2, None)], "id long, v string"), "b.t": spark.createDataFrame([(1, 2)], "y int, x int")}
    plan = SnapshotPlan(prefix="cdc", routes=[("^b", "cdc.bees")], host="h", port=1, database="d", ts_ms=5, tables=keyed_tables(frames, key_columns))
    got = {r["topic"]: r for r in plan.messages().collect()}
    first, second = got["cdc.a.t"], got["cdc.bees"]
    assert bytes(first["key"]) == b'{"id":2}' and bytes(first["value"]) == b'{"id":2,"total":1,"v":null}'
    assert bytes(second["key"]) == b'{"x":2,"y":1}'
    assert [(h["key"], bytes(h["value"])) for h in first["headers"]][1:] == [
        ("ts_ms", b"5"), ("host", b"h"), ("port", b"1"), ("database", b"d"), ("table", b"a.t"),
    ]
    with pytest.raises(ValueError):
        keyed_tables({"t": frames["a.t"]}, key_columns)


def test_snapshot_job(spark):
    table = SnapshotTable("a.t", spark.range(5), ["id"])
    out = jobs.run(spark, "table.snapshot", {"tables": [table], "condition": "WHERE id > 2", "message": {"total": False}})
    assert sorted(json.loads(bytes(r["value"]))["id"] for r in out.collect()) == [3, 4]
    stamp = out.select(F.element_at(F.filter("headers", lambda h: h["key"] == "ts_ms"), 1)["value"].cast("string")).first()[0]
    assert int(stamp) > 1_700_000_000_000


def test_table_read_options():
    whole = tables.table_options("jdbc:x", "public.t", "WHERE a > 1")
    assert whole["query"] == "SELECT * FROM public.t WHERE a > 1" and "dbtable" not in whole
    split = tables.table_options("jdbc:x", "public.t", partition_column="id", bounds=(0, 100), partitions=8, login={"user": "u"})
    assert split["dbtable"] == "(SELECT * FROM public.t) data" and "query" not in split
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"], split["user"]) == ("0", "100", "8", "u")
    with pytest.raises(ValueError):
        tables.table_options("jdbc:x", "t", partition_column="id")


def test_split_reads_ask_for_bounds(monkeypatch, spark):
    asked = []

    def read(_, options):
        asked.append(options)
        return spark.createDataFrame([(5, 90)], "low long, high long")

    monkeypatch.setattr(tables, "read_table", read)
    tables.read_split_table(spark, "jdbc:x", "public.t", "id", 4, "WHERE a > 1", {"user": "u"})
    assert asked[0]["query"] == "SELECT min(id) AS low, max(id) AS high FROM public.t WHERE a > 1"
    assert (asked[1]["lowerBound"], asked[1]["upperBound"], asked[1]["numPartitions"]) == ("5", "90", "4")
    assert asked[1]["dbtable"] == "(SELECT * FROM public.t WHERE a > 1) data"


def test_topic_source_options():
    options = kafka.source_options(["a:1", "b:2"], ["t", "u"], "g", workers_per_topic=3, fetch_max_bytes=5, fetch_max_partition_bytes=6)
    assert options == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "t,u",
        "includeHeaders": "true",
        "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed",
        "kafka.group.id": "g",
        "minPartitions": "6",
        "maxOffsetsPerTrigger": "60000",
        "kafka.fetch.max.bytes": "5",
        "kafka.max.partition.fetch.bytes": "6",
    }
    assert "maxOffsetsPerTrigger" not in kafka.source_options(["a"], ["t"], batch_size=None)
    for brokers, topics in (([], ["t"]), (["a"], [])):
        with pytest.raises(ValueError):
            kafka.source_options(brokers, topics)


@pytest.mark.parametrize(
    "protocol, mechanism",
    [("plain", "PLAIN"), ("scram-256", "SCRAM-SHA-256"), ("scram-512", "SCRAM-SHA-512"), ("oauth", "OAUTHBEARER"), ("aws", "AWS_MSK_IAM")],
)
def test_logins(protocol, mechanism):
    options = kafka.sasl_options(protocol, user="u", password='p"\\', is_token=True, token="x", callback_handler="C")
    assert options["kafka.sasl.mechanism"] == mechanism and options["kafka.security.protocol"] == "SASL_SSL"
    jaas = options["kafka.sasl.jaas.config"]
    assert jaas.endswith(";") and " required" in jaas
    if protocol in ("plain", "scram-256", "scram-512"):
        assert 'username="u" password="p\\"\\\\"' in jaas
    assert ("tokenauth" in jaas) == protocol.startswith("scram")
    assert kafka.source_options(["a"], ["t"], sasl=options)["kafka.sasl.mechanism"] == mechanism


def test_unknown_login():
    with pytest.raises(ValueError):
        kafka.sasl_options("oath")


def test_topic_sink_options(spark):
    assert kafka.sink_options(["a"], "lz4", 60_000) == {
        "kafka.bootstrap.servers": "a",
        "includeHeaders": "true",
        "kafka.compression.type": "lz4",
        "kafka.delivery.timeout.ms": "60000",
    }
    df = spark.createDataFrame([("t", 3, b"k", b"v", None, 1)], "topic string, partition int, key binary, value binary, headers string, offset long")
    assert kafka.outgoing(df).columns == ["topic", "key", "value", "headers"]
    assert kafka.outgoing(df, keep_partition=True).columns == ["topic", "key", "value", "headers", "partition"]


def test_triggers():
    assert every("5s") == {"processingTime": "5000 milliseconds"}
    assert every(None) == {"availableNow": True}
