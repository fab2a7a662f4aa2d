import gzip
import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from relayframe import session
from relayframe.operators import archive, offsets
from relayframe.plans.restore import restore, restore_archive
from relayframe.schemas import LOG, RESTORE_OFFSETS
from relayframe.sources import archive_files as files
from relayframe.streaming import jobs
from relayframe.streaming.archive_sink import ArchiveSink

START = datetime(2024, 5, 15, 10)


def record(offset, topic="t", partition=0, minutes=0, key=b"k", value=b"v", headers=()):
    return (
        topic,
        partition,
        offset,
        START + timedelta(minutes=minutes),
        None if key is None else bytearray(key),
        None if value is None else bytearray(value),
        [(k, None if v is None else bytearray(v)) for k, v in headers],
    )


def log(spark, *records):
    return spark.createDataFrame(list(records), LOG)


def plain(df, *columns):
    columns = columns or ("topic", "partition", "offset", "key", "value", "headers")
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_compatible_rows_turn_null_into_empty(spark):
    rows = archive.to_archive_rows(log(spark, record(0, key=None, value=b"", headers=[("h", None)])))
    row = rows.first()
    assert (row["key"], row["value"], row["headers"][0]["value"]) == ("", "", "")
    assert row["bucket"] == "2024-05-15 10:00:00"
    missing = log(spark, record(0)).withColumn("headers", F.lit(None).cast(LOG["headers"].dataType))
    assert archive.to_archive_rows(missing).first()["headers"] == []


def test_base64_rows_keep_everything(spark):
    source = log(spark, record(0, key=None, value=b"\xff\x00"), record(1, key=b"", headers=[("h", b"\x80"), ("n", None)]))
    rows = archive.to_archive_rows(source, binary="base64", keep_nulls=True, keep_timestamp=True)
    back = archive.from_archive_rows(rows, binary="base64")
    assert plain(back, *LOG.names) == plain(source, *LOG.names)


def test_hot_bucket_is_split_and_round_trips(spark, tmp_path):
    root = str(tmp_path / "a")
    source = log(spark, *[record(o, value=str(o).encode(), headers=[("h", b"x")]) for o in range(100)])
    ArchiveSink(root, chunk_offsets=30)(source)
    chunks = files.list_archive(spark, root).orderBy("min_offset").collect()
    assert [(c["min_offset"], c["max_offset"], c["n_rows"]) for c in chunks] == [(0, 29, 30), (30, 59, 30), (60, 89, 30), (90, 99, 10)]
    assert all(c["size_bytes"] > 0 for c in chunks)
    assert plain(restore(files.read_archive(spark, root)).records) == plain(source)
    lines = [json.loads(x) for f in (tmp_path / "a").rglob("*.gz") for x in gzip.open(f, "rt")]
    assert set(lines[0]) == {"offset", "key", "value", "headers"}
    for file in (tmp_path / "a").rglob("*.gz"):
        found = [json.loads(x)["offset"] for x in gzip.open(file, "rt")]
        assert found == sorted(found)


def test_writing_again_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "a")
    source = log(spark, *[record(o, minutes=o) for o in range(90)])
    for _ in range(2):
        ArchiveSink(root)(source)
    assert files.read_archive(spark, root).count() == 90


def test_manifest_measured_from_rows_equals_the_listing(spark, tmp_path):
    root = str(tmp_path / "a")
    ArchiveSink(root, chunk_offsets=20)(log(spark, *[record(o, minutes=o) for o in range(90)]))
    columns = ("topic", "bucket", "partition", "min_offset", "max_offset", "n_rows", "size_bytes")
    measured = files.read_archive(spark, root).groupBy(
        *columns[:3], F.col("_metadata.file_size").alias("size_bytes"), "_metadata.file_path"
    ).agg(F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset"), F.count("*").alias("n_rows"))
    assert plain(measured, *columns) == plain(
        files.list_archive(spark, root), *columns
    )


def test_range_reads_only_its_buckets(spark, tmp_path):
    root = str(tmp_path / "a")
    ArchiveSink(root)(log(spark, *[record(o, minutes=60 * o, topic="tu"[o % 2]) for o in range(6)]))
    rows = files.read_archive(spark, root, ["t"], "2024-05-15 10:00:01", "2024-05-15 14:00:00")
    assert plain(rows, "offset") == [(2,), (4,)]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "bucket" in filters and "topic" in filters


def test_compaction_keeps_every_record_once(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    records = [record(o, minutes=o, value=f"{o}".encode()) for o in range(200)]
    rng = random.Random(7)
    for _ in range(6):
        low = rng.randrange(200)
        ArchiveSink(source)(log(spark, *records[low : low + 80]))
    # A late delivery lying inside what is there already, and one filling a hole.
    ArchiveSink(source)(log(spark, *records[20:25]))
    ArchiveSink(source)(log(spark, *[r for r in records if r[2] % 3]))
    ArchiveSink(source)(log(spark, *records))
    files.compact_archive(spark, source, target)
    compacted = files.read_archive(spark, target)
    assert plain(compacted, "offset", "value") == sorted([(o, str(o)) for o in range(200)], key=repr)
    assert compacted.select("bucket", "chunk").distinct().count() == compacted.select("bucket").distinct().count()
    with pytest.raises(ValueError):
        files.compact_archive(spark, source, source + "/")


def test_compaction_of_one_range(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    for part in range(3):
        ArchiveSink(source)(log(spark, *[record(o, minutes=o) for o in range(part * 60, part * 60 + 60, 2)]))
    files.compact_archive(spark, source, target, since="2024-05-15 11:00:00", until="2024-05-15 11:00:00", limit=1)
    assert plain(files.read_archive(spark, target), "offset") == sorted([(o,) for o in range(60, 120, 2)], key=repr)


def test_previous_chunk_across_tiles(spark, as_rows):
    bounds = [(0, 3), (4, 4), (9, 20), (21, 22), (90, 95)]
    chunks = spark.createDataFrame(
        [("t", "b", p, low, high) for p in (0, 1) for low, high in bounds],
        "topic string, bucket string, partition int, min_offset bigint, max_offset bigint",
    )
    previous = [(None, None), *bounds[:-1]]
    expected = sorted([("t", "b", p, *c, *q) for p in (0, 1) for c, q in zip(bounds, previous)], key=repr)
    for tile in (1, 10, 1000):
        assert as_rows(archive.with_previous_chunk(chunks, tile)) == expected


def compatible(tmp_path, topic, bucket, partition, name, *members):
    folder = tmp_path / topic / bucket / str(partition)
    folder.mkdir(parents=True, exist_ok=True)
    lines = [
        "".join(json.dumps({"offset": o, "key": "k", "value": str(o), "headers": [{"key": "h", "value": "x"}]}) + "\n" for o in m)
        for m in members
    ]
    (folder / name).write_bytes(b"".join(gzip.compress(text.encode()) for text in lines))


def test_compatible_layout(spark, tmp_path):
    compatible(tmp_path, "t+1", "2024-05-15 10:00:00", 3, f"{0:018d}-{9:018d}.gz", range(5), range(5, 10))
    compatible(tmp_path, "t+1", "2024-05-15 10:00:00", 3, f"{8:018d}-{12:018d}.gz", range(8, 13))
    compatible(tmp_path, "t+1", "2024-05-15 11:00:00", 3, f"{13:018d}-{13:018d}.gz", [13])
    compatible(tmp_path, "other", "2024-05-15 11:00:00", 0, f"{0:018d}-{0:018d}.gz", [0])
    root = str(tmp_path)
    rows = files.read_compatible(spark, root, ["t+1"])
    assert rows.count() == 16
    records = restore(rows).records
    assert plain(records, "topic", "partition", "offset") == sorted([("t+1", 3, o) for o in range(14)], key=repr)
    listed = files.list_compatible(spark, root, ["t+1"], since="2024-05-15 11:00:00")
    assert plain(listed, "topic", "bucket", "partition", "min_offset", "max_offset") == [("t+1", "2024-05-15 11:00:00", 3, 13, 13)]
    assert listed.first()["size_bytes"] > 0
    ranged = files.read_compatible(spark, root, ["t+1", "other"], until="2024-05-15 10:59:59")
    assert plain(ranged.select("offset").distinct(), "offset") == sorted([(o,) for o in range(13)], key=repr)


def test_compatible_layout_is_written(spark, tmp_path):
    source = log(spark, *[record(o, minutes=o, headers=[("h", b"x")]) for o in range(100)])
    rows = archive.to_archive_rows(source)
    for _ in range(2):
        manifest = files.write_compatible(rows, f"file://{tmp_path}/a", chunk_offsets=40, partitions=1)
    written = sorted(str(f.relative_to(tmp_path / "a")) for f in (tmp_path / "a").rglob("*") if f.is_file())
    names = [("10", 0, 39), ("10", 40, 59), ("11", 60, 79), ("11", 80, 99)]
    assert written == [f"t/2024-05-15 {hour}:00:00/0/{low:018d}-{high:018d}.gz" for hour, low, high in names]
    assert sorted((r["min_offset"], r["n_rows"]) for r in manifest.collect()) == [(0, 40), (40, 20), (60, 20), (80, 20)]
    assert plain(files.list_compatible(spark, f"{tmp_path}/a", ["t"]), "min_offset", "size_bytes") == plain(
        manifest, "min_offset", "size_bytes"
    )
    line = json.loads(next(gzip.open(tmp_path / "a" / written[0], "rt")))
    assert line == {"offset": 0, "key": "k", "value": "v", "headers": [{"key": "h", "value": "x"}]}
    assert plain(restore(files.read_compatible(spark, f"{tmp_path}/a", ["t"])).records) == plain(source)


def test_malformed_chunk_path_fails(spark, tmp_path):
    compatible(tmp_path, "t", "2024-05-15 10:00:00", 0, "notes.gz", [0])
    for since in (None, "2024-05-15 12:00:00"):
        with pytest.raises(Exception, match="invalid chunk path"):
            files.list_compatible(spark, str(tmp_path), ["t"], since=since).collect()
        with pytest.raises(Exception, match="invalid chunk path"):
            files.read_compatible(spark, str(tmp_path), ["t"], since=since).collect()


def marks(spark, *rows):
    return spark.createDataFrame(list(rows), RESTORE_OFFSETS)


def test_restore_in_parts_out_of_time_order(spark):
    # The later bucket holds the lower offsets.
    rows = archive.to_archive_rows(log(spark, *[record(o, minutes=0 if o > 4 else 70) for o in range(10)]))
    late = restore(archive.in_buckets(rows, since="2024-05-15 11:00:00"))
    assert plain(late.records, "offset") == [(o,) for o in range(5)]
    early = restore(rows, late.marks)
    assert plain(early.records, "offset") == [(o,) for o in range(5, 10)]
    assert plain(early.counters, "topic", "restored", "skipped") == [("t", 5, 5)]
    again = restore(rows, early.marks)
    assert again.records.count() == 0


def test_restore_counts_copies_as_skipped(spark):
    rows = archive.to_archive_rows(log(spark, *[record(o) for o in range(4)]))
    done = restore(rows.unionAll(rows), marks(spark, ("t", 0, "2024-05-15 10:00:00", 0)))
    assert plain(done.records, "offset") == [(1,), (2,), (3,)]
    assert plain(done.counters, "topic", "restored", "skipped") == [("t", 3, 5)]


def test_restore_in_order(spark):
    records = [record(o, partition=p, minutes=o) for o in range(50) for p in (0, 1)]
    random.Random(1).shuffle(records)
    rows = archive.to_archive_rows(log(spark, *records))
    ordered = restore(rows, in_order=True).records.collect()
    for p in (0, 1):
        assert [r["offset"] for r in ordered if r["partition"] == p] == list(range(50))


def test_late_records_join_their_bucket(spark, tmp_path):
    root = str(tmp_path / "a")
    sink = ArchiveSink(root)
    sink(log(spark, record(0), record(1, minutes=120)))
    sink(log(spark, record(2, minutes=1)))
    assert plain(files.read_archive(spark, root), "bucket", "offset") == [
        ("2024-05-15 10:00:00", 0), ("2024-05-15 10:00:00", 2), ("2024-05-15 12:00:00", 1),
    ]


def test_batch_sizes_and_topics(spark, as_rows):
    records = log(spark, record(0), record(11), record(12), record(0, topic="u"))
    sizes = offsets.batch_sizes(records, F.call_function("div", F.col("offset"), F.lit(10)))
    assert as_rows(sizes) == [("t", 0, 1), ("t", 1, 2), ("u", 0, 1)]
    assert as_rows(offsets.topics_of(records)) == [("t",), ("u",)]


def brute_overlaps(chunks):
    return sorted(
        c for i, c in enumerate(chunks)
        if any(i != j and c[0] == d[0] and c[2] == d[2] and c[3] <= d[4] and d[3] <= c[4] for j, d in enumerate(chunks))
    )


@pytest.mark.parametrize("tile", [1, 9, 50, 10_000])
def test_overlapping_chunks(spark, tile):
    rng = random.Random(tile)
    chunks = set()
    for _ in range(60):
        low = rng.randrange(400)
        chunks.add((rng.choice("tu"), rng.choice("ab"), rng.randrange(2), low, low + rng.choice([0, 1, 4, 60])))
    chunks = sorted(chunks)
    schema = "topic string, bucket string, partition int, min_offset bigint, max_offset bigint"
    copied = ("t", "a", 0, 1000, 1001)
    df = spark.createDataFrame([*chunks, copied, copied, ("t", "a", 0, 1002, 1003)], schema)
    found = archive.overlapping(df, tile).collect()
    assert sorted(tuple(r)[:5] for r in found) == sorted([*brute_overlaps(chunks), copied])
    # Every offset that two chunks may hold is disputed in both.
    disputed = {
        (*tuple(r)[:5], o)
        for r in found
        for o in range(r.min_offset, r.max_offset + 1)
        if (r.shared_until is not None and o <= r.shared_until) or (r.shared_from is not None and o >= r.shared_from)
    }
    for c in chunks:
        for d in chunks:
            if c != d and c[0] == d[0] and c[2] == d[2]:
                assert all((*c, o) in disputed for o in range(max(c[3], d[3]), min(c[4], d[4]) + 1))


def test_restore_shuffles_only_overlaps(spark, tmp_path):
    root = str(tmp_path / "a")
    sink = ArchiveSink(root, chunk_offsets=10)
    source = log(spark, *[record(o, minutes=o) for o in range(100)])
    sink(source)
    sink(log(spark, *[record(o, minutes=o) for o in range(35, 52)]))
    narrow = files.disputed_rows(files.read_archive(spark, root), files.list_archive(spark, root))
    # The chunk of 40 to 49 was delivered whole, so the second delivery replaced it.
    assert sorted(r["offset"] for r in narrow.collect()) == sorted([*range(35, 40), *range(50, 52)] * 2)
    repeated = files.repeated_records(narrow)
    assert sorted((r["offset"], r["n"]) for r in repeated.collect()) == [(o, 2) for o in (*range(35, 40), 50, 51)]
    done = restore_archive(spark, root, since="2024-05-15 10:00:00", marks=marks(spark, ("t", 0, "2024-05-15 11:00:00", 89)))
    assert plain(done.records, "offset") == sorted([(o,) for o in range(100) if o < 60 or o > 89], key=repr)
    assert plain(done.counters, "topic", "restored", "skipped") == [("t", 70, 37)]
    assert plain(done.marks, "bucket", "offset") == [("2024-05-15 10:00:00", 59), ("2024-05-15 11:00:00", 99)]


def test_restore_reads_only_what_is_ahead(spark, tmp_path):
    root = str(tmp_path / "a")
    ArchiveSink(root, chunk_offsets=10)(log(spark, *[record(o, minutes=o) for o in range(100)]))
    assert files.disputed_rows(files.read_archive(spark, root), files.list_archive(spark, root)) is None
    half = restore_archive(spark, root, marks=marks(spark, ("t", 0, "2024-05-15 10:00:00", 34)))
    assert plain(half.records, "offset") == sorted([(o,) for o in range(35, 100)], key=repr)
    assert plain(half.counters, "topic", "restored", "skipped") == [("t", 65, 35)]
    plan = half.records._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert "SortAggregate" not in plan and "hashpartitioning" not in plan
    whole = restore_archive(spark, root)
    assert plain(whole.counters, "topic", "restored", "skipped") == [("t", 100, 0)]
    again = restore_archive(spark, root, marks=whole.marks)
    assert again.records.count() == 0
    assert plain(again.counters, "topic", "restored", "skipped") == [("t", 0, 100)]
    assert restore_archive(spark, root, ["t", "nothing"]).records.count() == 100
    assert restore_archive(spark, root, ["nothing"]).records.count() == 0


def test_equal_bounds_and_counts_do_not_replace(spark, tmp_path):
    root = str(tmp_path / "a")
    for offsets_ in ([0, 3, 9], [0, 5, 9]):
        ArchiveSink(root)(log(spark, *[record(o) for o in offsets_]))
    assert plain(restore_archive(spark, root).records, "offset") == sorted([(o,) for o in (0, 3, 5, 9)], key=repr)


def test_a_chunk_holds_an_offset_once(spark, tmp_path):
    root = str(tmp_path / "a")
    ArchiveSink(root)(log(spark, *[record(o) for o in range(10)] * 2))
    assert files.read_archive(spark, root).count() == 10
    assert files.list_archive(spark, root).first()["n_rows"] == 10


def test_appended_twice_is_restored_once(spark, tmp_path):
    root = str(tmp_path / "a")
    rows = archive.to_archive_rows(log(spark, *[record(o) for o in range(10)]))
    for _ in range(2):
        files.write_archive(rows, root, replace=False)
    assert files.read_archive(spark, root).count() == 20
    assert restore_archive(spark, root).records.count() == 10
    files.compact_archive(spark, root, str(tmp_path / "b"))
    assert files.read_archive(spark, str(tmp_path / "b")).count() == 10


def test_compatible_chunks_of_the_same_bounds_are_merged(spark, tmp_path):
    root = f"file://{tmp_path}/a"
    for delivery in ((1, 5, 10), (1, 7, 10)):
        rows = archive.to_archive_rows(log(spark, *[record(o) for o in delivery]))
        files.write_compatible(rows, root)
    topic = next(p.name for p in (tmp_path / "a").iterdir())
    assert sorted(r["offset"] for r in files.read_compatible(spark, root, [topic]).collect()) == [1, 5, 7, 10]
    assert not [p for p in (tmp_path / "a").rglob("*") if p.suffix == ".part"]


def test_compaction_keeps_timestamps_or_refuses(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    records = log(spark, *[record(o, minutes=o) for o in range(5)])
    ArchiveSink(source, keep_timestamp=True)(records)
    files.compact_archive(spark, source, target)
    kept = files.read_archive(spark, target, with_timestamp=True)
    assert kept.where("timestamp is null").isEmpty() and kept.count() == 5


def test_a_chunk_name_needs_its_dot(spark):
    path = spark.createDataFrame([("file:/a/t/2024-01-01 00:00:00/0/1-9Xgz",)], "path string")
    with pytest.raises(Exception, match="invalid chunk path"):
        path.select(archive.parse_chunk_path(F.col("path"))).collect()


def test_readers_see_one_version_of_a_compacted_archive(spark, tmp_path):
    conf = {"root": str(tmp_path / "a"), "pointer": str(tmp_path / "current")}
    assert files.current_root(spark, conf["pointer"], conf["root"]) == conf["root"]
    ArchiveSink(conf["root"], chunk_offsets=5)(log(spark, *[record(o) for o in range(30)]))
    places = []
    for n in (1, 2):
        manifest = jobs.run(spark, "archive.compact", conf | {"target": str(tmp_path / f"b{n}")})
        places.append(files.current_root(spark, conf["pointer"], conf["root"]))
        assert manifest.agg(F.sum("n_rows")).first()[0] == 30
    assert places == [str(tmp_path / "b1"), str(tmp_path / "b2")]
    with pytest.raises(ValueError, match="new location"):
        jobs.run(spark, "archive.compact", conf | {"target": places[-1]})
    assert files.current_root(spark, conf["pointer"], conf["root"]) == places[-1]


def late_log(spark, n=600):
    """Ten records a minute, one in five of them two minutes late: neighbouring hours overlap."""
    rows = [record(o, minutes=o // 10 - (2 if o % 5 == 0 and o > 50 else 0)) for o in range(n)]
    return log(spark, *rows)


def test_late_records_without_repeats_shuffle_no_payload(spark, tmp_path):
    root = str(tmp_path / "a")
    source = late_log(spark, 2_000)
    ArchiveSink(root)(source)
    manifest = files.list_archive(spark, root)
    assert archive.overlapping(manifest).count() == manifest.count() == 4
    narrow = files.disputed_rows(files.read_archive(spark, root), manifest)
    assert 0 < narrow.count() < 200
    restored = restore_archive(spark, root)
    plan = restored.records._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    assert plain(restored.records, "offset") == sorted([(o,) for o in range(2_000)], key=repr)
    assert plain(restored.counters, "topic", "restored", "skipped") == [("t", 2_000, 0)]


def test_repeats_of_a_late_log_are_restored_once(spark, tmp_path):
    """A redelivery puts records into chunks of other bounds; marks cut through one of them."""
    root = str(tmp_path / "a")
    sink = ArchiveSink(root)
    sink(late_log(spark))
    sink(late_log(spark).where("offset between 100 and 399"))
    whole = restore_archive(spark, root)
    assert plain(whole.records, "offset") == sorted([(o,) for o in range(600)], key=repr)
    assert plain(whole.counters, "topic", "restored", "skipped") == [("t", 600, 300)]
    buckets = {r["bucket"] for r in files.list_archive(spark, root).collect()}
    half = restore_archive(spark, root, marks=marks(spark, *[("t", 0, b, 249) for b in buckets]))
    assert plain(half.records, "offset") == sorted([(o,) for o in range(250, 600)], key=repr)
    assert plain(half.counters, "topic", "restored", "skipped") == [("t", 350, 550)]
    target = str(tmp_path / "b")
    files.compact_archive(spark, root, target)
    assert plain(files.read_archive(spark, target), "offset") == sorted([(o,) for o in range(600)], key=repr)


def test_compatible_restore_shuffles_offsets_only(spark, tmp_path):
    root = f"{tmp_path}/a"
    rows = archive.to_archive_rows(late_log(spark))
    files.write_compatible(rows, root)
    records = restore(files.read_compatible(spark, root, ["t"])).records
    assert "Exchange" not in records._jdf.queryExecution().executedPlan().toString()
    assert plain(records, "offset") == sorted([(o,) for o in range(600)], key=repr)


def test_compatible_layout_is_written_where_only_spark_reaches(spark, tmp_path):
    """A store that only Hadoop's readers know, as on a cluster."""
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.archives.link./a", f"file://{tmp_path}")
    root = "viewfs://archives/a/root"
    for part in ("offset % 2 = 0 or offset = 599", "offset % 2 = 1 or offset = 0"):
        manifest = files.write_compatible(archive.to_archive_rows(late_log(spark).where(part), "24h"), root)
        assert manifest.agg(F.sum("n_rows")).first()[0] in (301, 600)
    records = restore(files.read_compatible(spark, root, ["t"])).records
    assert plain(records, "offset") == sorted([(o,) for o in range(600)], key=repr)
    assert [p.name for p in (tmp_path / "root").iterdir()] == ["t"]


def test_compatible_layout_is_written_on_a_cluster_with_shared_folders(spark, tmp_path, monkeypatch):
    session.shared_dir(spark)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    rows = archive.to_archive_rows(late_log(spark))
    assert files.write_compatible(rows.limit(0), f"file://{tmp_path}/a").isEmpty()
    files.write_compatible(rows, f"file://{tmp_path}/a")
    assert files.read_compatible(spark, f"file://{tmp_path}/a", ["t"]).count() == 600


def test_tasks_follow_the_rows(spark, tmp_path, monkeypatch):
    """A redelivered archive: neither its write nor its compaction nor its restore gives a task more with more rows."""
    monkeypatch.setattr(session, "TASK_ROWS", 100, raising=False)
    # Too many repeats to broadcast them.
    monkeypatch.setattr(session.is_small, "__defaults__", (0,)) if hasattr(session, "is_small") else None
    root = str(tmp_path / "a")
    sink = ArchiveSink(root, interval="1m", replace=False)
    for part in ("offset < 1000", "true"):
        sink(late_log(spark, 2_000).where(part))

    def most(df):
        return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

    merged = files.merged_chunks(spark, root, limit=1)
    restored = restore_archive(spark, root).records
    for whole in (merged, restored):
        assert plain(whole, "offset") == sorted([(o,) for o in range(2_000)], key=repr)
    assert most(archive.by_offset_range(archive.to_archive_rows(late_log(spark, 2_000), "1m"))) < 300
    assert most(merged) < 300 and most(restored) < 300


def test_compatible_redelivery_replaces_no_file(spark, tmp_path):
    """What executors have read stays as it is; a sign of percent in the root is no code."""
    root = f"file://{tmp_path}/50%/a"
    parts = ("offset % 2 = 0 or offset = 599", "offset % 2 = 1 or offset = 0")
    files.write_compatible(archive.to_archive_rows(late_log(spark).where(parts[0]), "24h"), root, chunk_offsets=1 << 40)
    before = {p: (p.stat().st_ino, p.read_bytes()) for p in (tmp_path / "50%").rglob("*.gz")}
    files.write_compatible(archive.to_archive_rows(late_log(spark).where(parts[1]), "24h"), root, chunk_offsets=1 << 40)
    assert before == {p: (p.stat().st_ino, p.read_bytes()) for p in before}
    listed = files.list_compatible(spark, root, ["t"])
    assert plain(listed, "min_offset", "max_offset") == [(0, 599), (1, 597)]
    rows = files.read_compatible(spark, root, ["t"])
    assert plain(rows, "offset") == sorted([(o,) for o in range(600)], key=repr)


def test_sparse_ranges_make_one_chunk(spark, tmp_path):
    """A file for each range would be as many files as a sparse log has ranges."""
    sparse = [record(o * 50) for o in range(400)]
    dense = [record(o, topic="dense") for o in range(400)]
    source = log(spark, *sparse, *dense)
    for _ in range(2):
        ArchiveSink(str(tmp_path / "a"), chunk_offsets=200)(source)
    chunks = files.list_archive(spark, str(tmp_path / "a"))
    assert set(plain(chunks, "topic", "min_offset", "max_offset", "n_rows")) == {
        ("dense", 0, 199, 200),
        ("dense", 200, 399, 200),
        *[("t", low, low + 750, 16) for low in range(0, 20_000, 800)],
    }
    assert chunks.count() == 27
    assert plain(restore_archive(spark, str(tmp_path / "a")).records) == plain(source)
