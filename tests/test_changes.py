import json
import math
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from relayframe.operators import changes as ch
from relayframe.operators.changes import OID
from relayframe.plans.changefeed import ChangeFeed, in_log_order
from relayframe.schemas import CHANGES, RAW_CHANGES, RELATIONS
from relayframe.streaming import jobs
from relayframe.sources.changelog import read_changes, store_position, stored_position, write_changes


def cell(name, kind, data, fmt="t", key=False):
    raw = None if data is None else bytearray(data.encode() if isinstance(data, str) else data)
    return (name, OID.get(kind, kind), key, fmt, raw)


def change(spark, *cells, op="I", relation="public.t", lsn=23):
    return spark.createDataFrame([(lsn, lsn + 1, op, 1, relation, list(cells))], CHANGES)


def value_of(df, **options):
    return json.loads(df.select(ch.tuple_json(F.col("cols"), **options)).first()[0])


def test_text_values(spark):
    df = change(
        spark,
        cell("z", "int8", "-5"),
        cell("flag", "bool", "t"),
        cell("off", "bool", "f"),
        cell("f", "float8", "1.5"),
        cell("nan", "float8", "NaN"),
        cell("price", "numeric", "123456789012345678901234567890.50"),
        cell("id", "uuid", "00010203-0405-0607-0809-0a0b0c0d0e0f"),
        cell("at", "timestamp", "2024-01-02 03:04:05.678"),
        cell("never", "timestamp", "infinity"),
        cell("zoned", "timestamptz", "2024-01-02 05:04:05.25+02"),
        cell("day", "date", "2024-01-02"),
        cell("doc", "jsonb", '{"b": [1, "x"]}'),
        cell("raw", "bytea", "\\x6869"),
        cell("note", "text", 'say "hi"\n<&>'),
        cell("other", 99999, "plain"),
        cell("nothing", "int4", None, "n"),
        cell("kept", "text", None, "u"),
    )
    assert value_of(df) == {
        "z": -5,
        "flag": True,
        "off": False,
        "f": 1.5,
        "nan": "NaN",
        "price": "123456789012345678901234567890.50",
        "id": "00010203-0405-0607-0809-0a0b0c0d0e0f",
        "at": 1704164645678,
        "never": 2**63 - 1,
        "zoned": "2024-01-02T03:04:05.25Z",
        "day": "2024-01-02T00:00:00Z",
        "doc": {"b": [1, "x"]},
        "raw": "aGk=",
        "note": 'say "hi"\n<&>',
        "other": "plain",
        "nothing": None,
        "kept": None,
    }
    text = df.select(ch.tuple_json(F.col("cols"))).first()[0]
    assert list(json.loads(text)) == sorted(json.loads(text))
    assert "kept" not in value_of(df, unchanged="omit")
    with pytest.raises(ValueError):
        ch.tuple_json(F.col("cols"), unchanged="drop")


def test_binary_values(spark):
    df = change(
        spark,
        cell("a", "int2", struct.pack(">h", -2), "b"),
        cell("b", "int4", struct.pack(">i", 70000), "b"),
        cell("c", "int8", struct.pack(">q", -(2**40)), "b"),
        cell("d", "bool", b"\x01", "b"),
        cell("e", "uuid", bytes(range(16)), "b"),
        cell("f", "timestamp", struct.pack(">q", 1_500_999), "b"),
        cell("g", "timestamp", struct.pack(">q", 2**63 - 1), "b"),
        cell("h", "timestamp", struct.pack(">q", -(2**63)), "b"),
        cell("i", "timestamp", struct.pack(">q", -1), "b"),
        cell("j", "text", "hi", "b"),
    )
    origin = 946_684_800_000
    assert value_of(df) == {
        "a": -2,
        "b": 70000,
        "c": -(2**40),
        "d": True,
        "e": "00010203-0405-0607-0809-0a0b0c0d0e0f",
        "f": origin + 1500,
        "g": 2**63 - 1,
        "h": -(2**63),
        "i": origin - 1,
        "j": "hi",
    }
    with pytest.raises(Exception, match="binary value of type 99999"):
        value_of(change(spark, cell("n", 99999, b"\x00", "b")))


def test_key_without_key_columns(spark):
    assert change(spark, cell("a", "int4", "1")).select(ch.key_json(F.col("cols"))).first()[0] == "{}"


def test_lsn_text(spark):
    df = spark.createDataFrame([((0x16 << 32) + 0xB374D848,), (0,)], "lsn bigint")
    assert [r[0] for r in df.select(ch.lsn_text(F.col("lsn"))).collect()] == ["16/B374D848", "0/0"]


def raw(spark, *rows):
    return spark.createDataFrame(rows, RAW_CHANGES)


def relations(spark):
    return spark.createDataFrame([(1, "public", "t", [("id", OID["int8"], True), ("v", OID["text"], False)])], RELATIONS)


def test_describe_picks_old_and_new_rows(spark):
    new = [("t", bytearray(b"1")), ("t", bytearray(b"new"))]
    old = [("t", bytearray(b"1")), ("n", None)]
    df = ch.describe(raw(spark, (10, 5, "U", 1, new, old), (20, 5, "D", 1, None, old), (30, 7, "O", None, None, None)), relations(spark))
    got = {r["lsn_start"]: r for r in df.collect()}
    assert [c["data"] for c in got[10]["cols"]] == [b"1", b"new"]
    assert [c["kind"] for c in got[20]["cols"]] == ["t", "n"]
    assert got[10]["relation"] == "public.t" and got[10]["lsn_end"] == 15
    assert ch.next_position(df).first()["position"] == 37


def test_unknown_relation_fails(spark):
    df = ch.describe(raw(spark, (10, 5, "I", 7, [("t", bytearray(b"1"))], None)), relations(spark))
    for reading in (df, df.select("cols"), df.select("relation"), ChangeFeed(tables=["public.t"]).selected(df).select("op")):
        with pytest.raises(Exception, match="no relation is described by id 7"):
            reading.collect()


def test_feed_filters_and_headers(spark, as_rows):
    rows = [
        change(spark, cell("id", "int8", "1", key=True), op=op, relation=rel, lsn=lsn)
        for lsn, (op, rel) in enumerate(
            [("I", "public.t"), ("D", "public.t"), ("O", "public.t"), ("I", "public.pipe_health"), ("I", "my_public.pipe_health"), ("U", "public.u")]
        )
    ]
    log = rows[0]
    for more in rows[1:]:
        log = log.unionByName(more)
    feed = ChangeFeed(skip_deletes=True, prefix="cdc", ts_ms=1)
    assert as_rows(feed.selected(log).select("lsn_start")) == [(0,), (5,)]
    assert as_rows(ChangeFeed(tables=["public.t"]).selected(log).select("lsn_start")) == [(0,), (1,)]
    message = feed.messages(log).where("topic = 'cdc.public.t'").first()
    headers = {h["key"]: bytes(h["value"]).decode() for h in message["headers"]}
    assert list(headers) == ["version", "lsn", "ts_ms", "host", "port", "database", "relation", "op"]
    assert headers["relation"] == "public.t" and headers["lsn"] == "0/0" and headers["op"] == "I"
    assert bytes(message["key"]) == b'{"id":1}'


def test_read_from_a_position(spark, tmp_path, as_rows):
    change(spark, lsn=5).unionByName(change(spark, lsn=9)).write.parquet(str(tmp_path / "log"))
    assert as_rows(read_changes(spark, str(tmp_path / "log"), 9).select("lsn_start")) == [(9,)]
    assert read_changes(spark, str(tmp_path / "log")).count() == 2


def test_stored_positions(spark, tmp_path):
    path = str(tmp_path / "position")
    assert stored_position(spark, path) is None
    store_position(change(spark, lsn=9), path, 0)
    store_position(change(spark, lsn=30).unionByName(change(spark, lsn=20, op="O")), path, 1)
    store_position(change(spark).limit(0), path, 2)
    assert stored_position(spark, path) == 31


def test_subscription_prunes_the_log(spark, tmp_path, as_rows):
    path = str(tmp_path / "log")
    write_changes(change(spark).unionByName(change(spark, relation="public.u", lsn=50)), path)
    df = ch.subscribed(read_changes(spark, path, 10), ["public.u"])
    assert as_rows(df.select("lsn_start", "relation")) == [(50, "public.u")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "relation" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(lsn_start,10)" in plan


def test_changes_job_over_a_stream(spark, tmp_path):
    path = str(tmp_path / "log")
    change(spark, cell("id", "int8", "1", key=True)).write.parquet(path)
    out = jobs.run(spark, "table.changes", {"path": path, "feed": {"prefix": "cdc", "ts_ms": 1}})
    assert out.isStreaming
    query = out.writeStream.format("memory").queryName("sent_changes").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [tuple(r) for r in spark.sql("SELECT topic, string(key) FROM sent_changes").collect()] == [("cdc.public.t", '{"id":1}')]


WIDE = [
    ("b_int", "int8", "-5"), ("a_flag", "bool", "t"), ("f", "float8", "NaN"), ("price", "numeric", "1.50"),
    ("at", "timestamp", "infinity"), ("zoned", "timestamptz", "2024-01-02 05:04:05+02"), ("day", "date", "2024-01-02"),
    ("doc", "jsonb", '{"b": 1}'), ("raw", "bytea", "\\x6869"), ("note", "text", 'q"'), ("other", 99999, "plain"),
]


def test_known_relations_give_the_same_messages(spark, tmp_path):
    described = [
        (1, "public", "t", [(n, OID.get(k, k), n == "b_int") for n, k, _ in WIDE]),
        (2, "public", "no_key", [("v", OID["text"], False)]),
        (3, "public", "pipe_health", [("v", OID["text"], False)]),
    ]
    relations_ = spark.createDataFrame(described, RELATIONS)
    full = [("t", bytearray(text.encode())) for _, _, text in WIDE]
    old = [full[0]] + [("n", None)] * (len(WIDE) - 1)
    part = full[:-1] + [("u", None)]
    short = [("t", bytearray(b"x"))]
    raw_ = raw(
        spark, (10, 5, "I", 1, full, None), (20, 5, "D", 1, None, old), (30, 5, "U", 1, part, None),
        (40, 5, "O", None, None, None), (50, 5, "I", 2, short, None), (60, 5, "I", 3, short, None),
    )
    for options in ({}, {"tables": ["public.t"]}, {"skip_deletes": True, "prefix": "cdc"}):
        feed = ChangeFeed(ts_ms=1, **options)
        known = sorted(map(repr, feed.raw_messages(raw_, relations_).collect()))
        general = sorted(map(repr, feed.messages(ch.describe(raw_, relations_)).collect()))
        assert known == general and known
    feed = ChangeFeed(ts_ms=1, unchanged="omit")
    assert sorted(map(repr, feed.raw_messages(raw_, relations_).collect())) == sorted(
        map(repr, feed.messages(ch.describe(raw_, relations_)).collect())
    )
    raw_.write.parquet(str(tmp_path / "raw"))
    sent = ChangeFeed(tables=["public.t"]).raw_messages(spark.read.schema(RAW_CHANGES).parquet(str(tmp_path / "raw")), relations_)
    plan = sent._jdf.queryExecution().executedPlan().toString()
    assert "Not(In(relation_id, [2,3]))" in plan.replace("StringIn", "In") and "Join" not in plan
    unknown = raw(spark, (10, 5, "I", 9, short, None))
    for options in ({}, {"tables": ["public.t"]}):
        with pytest.raises(Exception, match="no relation is described by id 9"):
            ChangeFeed(**options).raw_messages(unknown, relations_).collect()
    refused = spark.createDataFrame([(2, "public", "t", [("v", 99999, False)])], RELATIONS)
    binary = raw(spark, (10, 5, "I", 2, [("b", bytearray(b"x"))], None))
    for messages in (ChangeFeed().raw_messages(binary, refused), ChangeFeed().messages(ch.describe(binary, refused))):
        with pytest.raises(Exception, match="binary value of type 99999"):
            messages.collect()


def _numeric(sign, weight, scale, *groups):
    return struct.pack(f">HhHH{len(groups)}H", len(groups), weight, sign, scale, *groups)


BINARY = [
    ("bool", b"\x01", "true"),
    ("int2", struct.pack(">h", -7), "-7"),
    ("int4", struct.pack(">i", -(2**31)), str(-(2**31))),
    ("int8", struct.pack(">q", -(2**63)), str(-(2**63))),
    ("oid", struct.pack(">I", 2**32 - 1), str(2**32 - 1)),
    ("float4", struct.pack(">f", 3.14), "3.14"),
    ("float8", struct.pack(">d", -1.1e-300), "-1.1E-300"),
    ("float8", struct.pack(">d", 5e-324), "4.9E-324"),
    ("float8", struct.pack(">d", 0.1 + 0.2), "0.30000000000000004"),
    ("float8", struct.pack(">d", math.inf), '"Infinity"'),
    ("numeric", _numeric(0, 1, 2, 12, 3456, 7000), '"123456.70"'),
    ("numeric", _numeric(0x4000, -2, 10, 12, 3400), '"-0.0000001234"'),
    ("numeric", _numeric(0, 2, 0, 1), '"100000000"'),
    ("numeric", _numeric(0, 0, 3), '"0.000"'),
    ("numeric", _numeric(0xC000, 0, 0), '"NaN"'),
    ("date", struct.pack(">i", -1), '"1999-12-31T00:00:00Z"'),
    ("timestamp", struct.pack(">q", -1), "946684799999"),
    ("timestamp", struct.pack(">q", 2**63 - 1), str(2**63 - 1)),
    ("timestamptz", struct.pack(">q", 1_500_000), '"2000-01-01T00:00:01.5Z"'),
    ("uuid", bytes(range(16)), '"00010203-0405-0607-0809-0a0b0c0d0e0f"'),
    ("bytea", b"\x00\xff", '"AP8="'),
    ("json", b'{"a": 1}', '{"a":1}'),
    ("jsonb", b"\x01[1, 2]", "[1,2]"),
    ("text", "é".encode(), '"é"'),
]


@pytest.mark.parametrize("columns_spelled_out", [1, 400])
def test_binary_cells_of_every_type(spark, columns_spelled_out):
    """The same on both paths, whatever the width of the schema."""
    described = [(i, "public", f"t{i}", [("v", OID[kind], False)]) for i, (kind, _, _) in enumerate(BINARY)]
    relations_ = spark.createDataFrame(described, RELATIONS)
    raw_ = raw(spark, *[(i, 1, "I", i, [("b", bytearray(data))], None) for i, (_, data, _) in enumerate(BINARY)])
    want = {f"public.t{i}": f'{{"v":{text}}}' for i, (_, _, text) in enumerate(BINARY)}
    known = ChangeFeed(ts_ms=1).raw_messages(raw_, relations_, columns_spelled_out=columns_spelled_out)
    for messages in (known, ChangeFeed(ts_ms=1).messages(ch.describe(raw_, relations_))):
        assert {r.topic: bytes(r.value).decode() for r in messages.collect()} == want


def test_a_relation_sent_again_holds_from_its_position(spark):
    schema = StructType([*RELATIONS.fields, StructField("since", LongType())])
    x, y = ("x", OID["int8"], True), ("y", OID["text"], False)
    versions = [(1, "public", "t", [x], None), (1, "public", "t2", [x, y], 20), (1, "public", "t2", [x], 30)]
    relations_ = spark.createDataFrame(versions + versions[:1], schema)
    one, two = [("t", bytearray(b"1"))], [("t", bytearray(b"1")), ("t", bytearray(b"a"))]
    raw_ = raw(spark, (10, 1, "I", 1, one, None), (20, 1, "I", 1, two, None), (29, 1, "I", 1, two, None), (30, 1, "I", 1, one, None))
    want = [
        ("public.t", '{"x":1}'),
        ("public.t2", '{"x":1,"y":"a"}'),
        ("public.t2", '{"x":1,"y":"a"}'),
        ("public.t2", '{"x":1}'),
    ]
    for options, rows in (({}, want), ({"tables": ["public.t2"]}, want[1:])):
        feed = ChangeFeed(ts_ms=1, **options)
        for messages in (feed.raw_messages(raw_, relations_, keep=("lsn_start",)), feed.messages(ch.describe(raw_, relations_), ("lsn_start",))):
            assert [(r.topic, bytes(r.value).decode()) for r in messages.orderBy("lsn_start").collect()] == rows
    clash = spark.createDataFrame([*versions, (1, "public", "other", [x], 20)], schema)
    for build in (lambda: ChangeFeed().raw_messages(raw_, clash), lambda: ch.describe(raw_, clash)):
        with pytest.raises(Exception, match="ambiguous versions of relation id 1"):
            build().collect()


def test_messages_of_one_key_keep_the_order_of_the_log(spark):
    relations_ = spark.createDataFrame([(1, "public", "t", [("id", OID["int8"], True), ("n", OID["int8"], False)])], RELATIONS)
    rows = [(n, 1, "U", 1, [("t", bytearray(str(n % 7).encode())), ("t", bytearray(str(n).encode()))], None) for n in range(300)]
    raw_ = raw(spark, *reversed(rows)).repartition(5)
    messages = in_log_order(ChangeFeed(ts_ms=1).raw_messages(raw_, relations_, keep=("lsn_start",)))
    tasks = messages.rdd.glom().collect()
    seen = {}
    for number, task in enumerate(tasks):
        for r in task:
            seen.setdefault(bytes(r.key), []).append((number, r.lsn_start))
    assert len(seen) == 7
    assert all(len({t for t, _ in places}) == 1 and places == sorted(places) for places in seen.values())
