"""Archives whose writes are committed as a whole, next to writers and readers that come between."""

import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from relayframe.plans.restore import restore_archive
from relayframe.sources import archive_commits
from relayframe.sources import archive_files as files
from relayframe.sources.archive_commits import ArchiveLog
from relayframe.streaming import jobs
from relayframe.streaming.archive_sink import ArchiveSink
from tests.test_archive import log, plain, record


def offsets_in(spark, archive_log, **bounds):
    rows = files.read_archive(spark, archive_log.data, folders=archive_log.folders(spark, **bounds), **bounds)
    return sorted(r["offset"] for r in rows.select("offset").collect())


def batch(spark, low, high, **kept):
    return log(spark, *[record(o, minutes=o, value=str(o).encode(), **kept) for o in range(low, high)])


@pytest.fixture
def place(tmp_path):
    root = str(tmp_path / "a")
    return ArchiveLog(root), ArchiveSink(root, commits=True, chunk_offsets=30)


def test_a_retry_adds_nothing(spark, place):
    archive_log, sink = place
    assert offsets_in(spark, archive_log) == []
    for batch_id, bounds in [(0, (0, 40)), (1, (40, 90)), (1, (40, 90)), (0, (0, 40))]:
        sink(batch(spark, *bounds), batch_id, "r")
    assert offsets_in(spark, archive_log) == list(range(90))
    assert [r["version"] for r in archive_log.commits(spark).orderBy("version").collect()] == [1, 2]
    # The same number in another run is another batch.
    sink(batch(spark, 90, 95), 1, "s")
    assert offsets_in(spark, archive_log) == list(range(95))


def test_a_killed_writer_leaves_nothing_to_see(spark, place, monkeypatch):
    archive_log, sink = place
    sink(batch(spark, 0, 10), 0, "r")

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(ArchiveLog, "_commit", killed)
        with pytest.raises(KeyboardInterrupt):
            sink(batch(spark, 10, 20), 1, "r")
    assert len(list(Path(archive_log.data).iterdir())) == 2
    assert offsets_in(spark, archive_log) == list(range(10))
    sink(batch(spark, 10, 20), 1, "r")
    assert offsets_in(spark, archive_log) == list(range(20))


def test_a_writer_killed_amid_its_data(spark, place, monkeypatch):
    archive_log, sink = place

    def half(labelled, folder):
        files_write(labelled.where("offset < 5"), folder)
        raise KeyboardInterrupt

    files_write = files.write_attempt
    with monkeypatch.context() as patch:
        patch.setattr(files, "write_attempt", half)
        with pytest.raises(KeyboardInterrupt):
            sink(batch(spark, 0, 10), 0, "r")
    assert offsets_in(spark, archive_log) == []
    sink(batch(spark, 0, 10), 0, "r")
    assert offsets_in(spark, archive_log) == list(range(10))


def test_readers_keep_what_they_resolved(spark, place):
    archive_log, sink = place
    sink(batch(spark, 0, 10), 0, "r")
    before = files.read_archive(spark, archive_log.data, folders=archive_log.folders(spark)).select("offset")
    folders = archive_log.folders(spark)
    sink(batch(spark, 10, 20), 1, "r")
    assert archive_log.compact(spark)
    sink(batch(spark, 20, 30), 2, "r")
    assert sorted(r[0] for r in before.collect()) == list(range(10))
    assert archive_log.folders(spark, version=1) == folders
    at_two = files.read_archive(spark, archive_log.data, folders=archive_log.folders(spark, version=2))
    assert at_two.count() == 20
    assert offsets_in(spark, archive_log) == list(range(30))


def test_two_drivers_commit_one_batch(spark, place, monkeypatch):
    archive_log, sink = place
    with monkeypatch.context() as patch:
        patch.setattr(ArchiveLog, "is_committed", lambda *_: False)
        sink(batch(spark, 0, 10), 0, "r")
        sink(batch(spark, 0, 10), 0, "r")
    assert archive_log.commits(spark).count() == 2
    assert offsets_in(spark, archive_log) == list(range(10))


def test_sinks_write_while_the_archive_is_compacted(spark, place, monkeypatch):
    archive_log, sink = place
    for part in range(4):
        sink(batch(spark, part * 10, part * 10 + 10), part, "r")
    # Delivered again under another number, as after a lost checkpoint.
    sink(batch(spark, 5, 25), 0, "s")
    write = ArchiveLog._write

    def meanwhile(self, labelled):
        attempt = write(self, labelled)
        if not archive_log.is_committed(spark, "r", 4):
            monkeypatch.undo()
            sink(batch(spark, 40, 50), 4, "r")
        return attempt

    monkeypatch.setattr(ArchiveLog, "_write", meanwhile)
    assert archive_log.compact(spark)
    assert offsets_in(spark, archive_log) == list(range(50))
    assert archive_log.live(spark).count() == 2
    assert archive_log.compact(spark) and not archive_log.compact(spark)
    assert offsets_in(spark, archive_log) == list(range(50))
    chunks = files.list_archive(spark, archive_log.data, folders=archive_log.folders(spark))
    assert chunks.count() == chunks.select("bucket").distinct().count()
    # A batch from before is still known.
    sink(batch(spark, 0, 10), 0, "r")
    assert offsets_in(spark, archive_log) == list(range(50))


def test_a_compaction_that_was_overtaken_fails(spark, place, monkeypatch):
    archive_log, sink = place
    sink(batch(spark, 0, 10), 0, "r")
    sink(batch(spark, 10, 20), 1, "r")
    write = ArchiveLog._write

    def overtaken(self, labelled):
        monkeypatch.undo()
        assert archive_log.compact(spark)
        return write(self, labelled)

    monkeypatch.setattr(ArchiveLog, "_write", overtaken)
    with pytest.raises(RuntimeError, match="another compaction"):
        archive_log.compact(spark)
    assert offsets_in(spark, archive_log) == list(range(20))


def test_only_folders_in_range_are_listed(spark, place):
    archive_log, sink = place
    for hour in range(4):
        sink(batch(spark, hour * 60, hour * 60 + 60), hour, "r")
    sink(batch(spark, 180, 200, topic="u"), 4, "r")
    bounds = {"topics": ["t"], "since": "2024-05-15 12:00:00", "until": "2024-05-15 12:00:00"}
    assert len(archive_log.folders(spark)) == 5
    assert len(archive_log.folders(spark, **bounds)) == 1
    rows = files.read_archive(spark, archive_log.data, folders=archive_log.folders(spark, since="2024-05-15 13:00:00"))
    assert {p.split("topic=")[1][0] for p in rows.inputFiles()} == {"t", "u"}
    assert len({p.split("attempt=")[1][:33] for p in rows.inputFiles()}) == 2
    assert offsets_in(spark, archive_log, **bounds) == list(range(120, 180))
    assert offsets_in(spark, archive_log, topics=["none"]) == []


def test_chunks_are_ordered_and_an_empty_batch_is_a_batch(spark, place):
    archive_log, sink = place
    records = batch(spark, 0, 100).orderBy(F.rand(3))
    sink(records.limit(0), 0, "r")
    sink(records, 1, "r")
    assert archive_log.commits(spark).count() == 2
    assert archive_log.is_committed(spark, "r", 0)
    stored = list(Path(archive_log.data).rglob("*.json.gz"))
    for path in stored:
        lines = [json.loads(line)["offset"] for line in gzip.open(path)]
        assert lines == sorted(lines)
    assert len(stored) == files.list_archive(spark, archive_log.data, folders=archive_log.folders(spark)).count()
    assert not list(Path(archive_log.data).rglob("_temporary"))


def test_restore_reads_committed_records_with_marks(spark, place):
    archive_log, sink = place
    sink(batch(spark, 0, 40), 0, "r")
    first = restore_archive(spark, archive_log.data, folders=archive_log.folders(spark))
    marks = spark.createDataFrame(first.marks.collect(), first.marks.schema)
    sink(batch(spark, 40, 100), 1, "r")
    second = restore_archive(spark, archive_log.data, marks=marks, folders=archive_log.folders(spark))
    assert plain(second.records, "offset") == sorted([(o,) for o in range(40, 100)], key=repr)
    assert [tuple(r) for r in second.counters.collect()] == [("t", 60, 40)]


def test_jobs_by_name(spark, place):
    archive_log, sink = place
    conf = {"root": archive_log.root, "commits": True, "topics": None, "since": None, "until": None}
    assert jobs.run(spark, "archive.restore", conf).count() == 0
    for part in range(3):
        sink(batch(spark, part * 20, part * 20 + 20), part, "r")
    manifest = jobs.run(spark, "archive.compact", conf)
    assert manifest.agg(F.sum("n_rows")).first()[0] == 60
    assert jobs.run(spark, "archive.restore", conf).count() == 60


def test_commit_columns(spark, place):
    archive_log, sink = place
    sink(batch(spark, 0, 90), 7, "r")
    commit = archive_log.live(spark).select(archive_commits.COMMIT.names).first()
    assert (commit["version"], commit["run"], commit["batch_id"], commit["replaced"]) == (1, "r", 7, [])
    assert [tuple(p) for p in commit["parts"]] == [("t", "2024-05-15 10:00:00", "2024-05-15 11:00:00", 90)]
