"""Logs with relations in them next to plain decoding."""

import json

import pytest

from relayframe.operators import changes as ch
from relayframe.operators.changes import OID
from relayframe.plans.changefeed import ChangeFeed
from relayframe.schemas import LOG_WITH_RELATIONS, RAW_CHANGES, RELATIONS
from relayframe.streaming import jobs
from relayframe.streaming.change_stream import RelationLog
from relayframe.streaming.table_sink import drain

X, Y, Z = (("x", OID["int8"], True), ("y", OID["text"], False), ("z", OID["bool"], False))


def relation(lsn, relation_id, name, *columns):
    return (lsn, 0, "R", relation_id, None, None, ("public", name, list(columns)))


def insert(lsn, relation_id, *texts):
    cells = [("n", None) if t is None else ("t", bytearray(t.encode())) for t in texts]
    return (lsn, 1, "I", relation_id, cells, None, None)


BATCHES = [
    [relation(0, 1, "t", X), insert(1, 1, "1"), relation(2, 2, "u", X, Y), insert(3, 2, "1", 'q"é')],
    # Altered within the batch; sent again as it was, which is no new version.
    [insert(10, 1, "2"), relation(11, 1, "t", X, Z), insert(12, 1, "3", "t"), relation(13, 2, "u", X, Y)],
    [insert(20, 1, "4", None), insert(21, 2, "2", "w"), relation(22, 1, "renamed", X), insert(23, 1, "5")],
]
WANT = [
    (1, "public.t", {"x": 1}),
    (3, "public.u", {"x": 1, "y": 'q"é'}),
    (10, "public.t", {"x": 2}),
    (12, "public.t", {"x": 3, "z": True}),
    (20, "public.t", {"x": 4, "z": None}),
    (21, "public.u", {"x": 2, "y": "w"}),
    (23, "public.renamed", {"x": 5}),
]


def run(spark, base, **feed):
    def send(messages, batch_id):
        messages.write.mode("overwrite").parquet(f"{base}/sent/batch={batch_id}")

    conf = {"path": f"{base}/log", "relations": "log", "versions": f"{base}/versions", "feed": {"ts_ms": 1} | feed}
    conf |= {"files_per_trigger": 1, "checkpoint": f"{base}/checkpoint", "timeout": None, "send": send}
    drain([jobs.run(spark, "table.changes", conf)])
    rows = spark.read.parquet(f"{base}/sent").orderBy("lsn_start").collect()
    return [(r.lsn_start, r.topic, json.loads(bytes(r.value))) for r in rows]


def append(spark, base, rows):
    spark.createDataFrame(rows, LOG_WITH_RELATIONS).coalesce(1).write.mode("append").parquet(f"{base}/log")


def test_relations_change_while_the_stream_runs(spark, tmp_path):
    for rows in BATCHES[:2]:
        append(spark, tmp_path, rows)
    assert run(spark, tmp_path) == WANT[:4]
    append(spark, tmp_path, BATCHES[2])  # a new run knows the versions of the earlier one
    assert run(spark, tmp_path) == WANT
    stored = spark.read.parquet(f"{tmp_path}/versions").collect()
    assert sorted((r.relation_id, r.since, r.batch_id) for r in stored) == [(1, 0, 0), (1, 11, 1), (1, 22, 2), (2, 2, 0)]


def test_subscribed_tables_and_renaming(spark, tmp_path):
    for rows in BATCHES:
        append(spark, tmp_path, rows)
    assert run(spark, tmp_path, tables=["public.t"]) == [w for w in WANT if w[1] == "public.t"]


def test_a_batch_run_again_replaces_what_it_stored(spark, tmp_path):
    log = RelationLog(str(tmp_path / "versions"))
    for _ in range(2):
        for batch_id, rows in enumerate(BATCHES):
            sent = ch.relations_in_log(spark.createDataFrame(rows, LOG_WITH_RELATIONS))
            versions = log.store(sent, batch_id)
    assert versions.count() == 4
    assert log.before(spark, 1).count() == 2


def test_a_longer_tuple_than_its_version_fails(spark, tmp_path):
    rows = [relation(0, 1, "t", X), insert(1, 1, "1", "more")]
    append(spark, tmp_path, rows)
    with pytest.raises(Exception, match="more values than columns in a change of relation id 1"):
        run(spark, tmp_path)
    relations = spark.createDataFrame([(1, "public", "t", [X])], RELATIONS)
    raw = spark.createDataFrame([r[:-1] for r in rows[1:]], RAW_CHANGES)
    feed = ChangeFeed(ts_ms=1)
    for messages in (feed.raw_messages(raw, relations), feed.messages(ch.describe(raw, relations))):
        with pytest.raises(Exception, match="more values than columns"):
            messages.collect()


def test_an_unknown_relation_fails(spark, tmp_path):
    append(spark, tmp_path, [insert(1, 9, "1")])
    with pytest.raises(Exception, match="no relation is described by id 9"):
        run(spark, tmp_path)


def test_bounded_log_with_relations_in_it(spark):
    rows = [r for batch in BATCHES for r in batch]
    log = spark.createDataFrame(rows, LOG_WITH_RELATIONS)
    found = jobs.run(spark, "table.changes", {"changes": log, "relations": "log", "feed": {"ts_ms": 1}}).collect()
    assert sorted((r.topic, bytes(r.value)) for r in found) == sorted(
        (topic, json.dumps(v, ensure_ascii=False, separators=(",", ":")).encode()) for _, topic, v in WANT
    )


@pytest.mark.parametrize("unchanged", ["null", "omit"])
def test_both_ways_to_decode_agree(spark, unchanged):
    columns = [(f"c{i}", OID[kind], i == 0) for i, kind in enumerate(["int8", "text", "bool", "float8", "jsonb", "numeric"])]
    relations = spark.createDataFrame([(1, "public", "t", columns)], RELATIONS)
    texts = ["7", 'a"\\\n', "f", "1e300", '{"b": [1, null]}', "1.50"]
    cells = [("t", bytearray(t.encode())) for t in texts]
    rows = [(i, 1, "U", 1, cells[:i] + [(kind, None)] + cells[i + 1 :], None) for i in range(6) for kind in "nu"]
    rows.append((9, 1, "D", 1, None, cells[:1]))
    raw = spark.createDataFrame(rows, RAW_CHANGES)
    feed = ChangeFeed(ts_ms=1, unchanged=unchanged)
    ways = (feed.raw_messages(raw, relations), feed.looked_up_messages(raw, relations))
    found = [sorted(map(repr, messages.collect())) for messages in ways]
    assert found[0] == found[1]


def test_many_columns_are_one_scan(spark, tmp_path):
    columns = [(f"c{i}", OID["int8"], i == 0) for i in range(250)]
    relations = spark.createDataFrame([(i, "public", f"t{i}", columns) for i in range(20)], RELATIONS)
    rows = [(i, 1, "I", i, [("t", bytearray(b"5"))] * 250, None) for i in range(20)]
    spark.createDataFrame(rows, RAW_CHANGES).write.parquet(f"{tmp_path}/raw")
    raw = spark.read.schema(RAW_CHANGES).parquet(f"{tmp_path}/raw")
    sent = ChangeFeed(ts_ms=1, tables=[f"public.t{i}" for i in range(19)]).raw_messages(raw, relations)
    plan = sent._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan and "relation_id" in plan.split("PushedFilters")[1]
    assert sent.count() == 19
    assert json.loads(bytes(sent.first().value)) == {f"c{i}": 5 for i in range(250)}
