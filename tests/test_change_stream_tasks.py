from pyspark.sql import functions as F

from relayframe import session
from workload import queries


def test_a_large_batch_is_decoded_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 400)
    base = str(tmp_path / "stream")
    monkeypatch.setattr(queries, "scratch_path", lambda *_: base)
    sent = queries.all_queries()["change_stream_altered"](spark, "/root/testdata/sf0.001")
    assert sent.count() == sent.select("lsn_start").distinct().count() == 1_500
    assert sorted(spark.read.parquet(f"{base}/sent").agg(F.sort_array(F.collect_set("batch"))).first()[0]) == [0, 1]
    log = spark.read.parquet(f"{base}/log").groupBy(F.input_file_name()).count()
    assert log.agg(F.max("count")).first()[0] < 1_000
