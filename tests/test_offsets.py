from pyspark.sql import functions as F

from relayframe.operators import offsets
from relayframe.session import lookup_join

LOG = "topic string, partition int, offset bigint"


def log(spark, *rows):
    return spark.createDataFrame(rows, LOG)


def test_gapped_offsets_lose_nothing(spark, as_rows):
    records = log(spark, *[("t", 0, o) for o in (0, 5, 9, 20, 21)])
    fresh = offsets.fresh_records(records, log(spark, ("t", 0, 9)))
    assert as_rows(fresh) == [("t", 0, 20), ("t", 0, 21)]


def test_unseen_partition_and_empty_state(spark, as_rows):
    records = log(spark, ("t", 0, 1), ("t", 1, 1), ("u", 0, 0))
    assert as_rows(offsets.fresh_records(records, log(spark, ("t", 0, 1)))) == [("t", 1, 1), ("u", 0, 0)]
    assert len(as_rows(offsets.fresh_records(records, records.limit(0)))) == 3


def test_marks_never_move_backwards(spark, as_rows):
    merged = offsets.merge_offsets(log(spark, ("t", 0, 50)), log(spark, ("t", 0, 10), ("t", 1, 3)))
    assert as_rows(merged) == [("t", 0, 50), ("t", 1, 3)]


def test_marks_before_ignores_the_batch_itself(spark, as_rows):
    ledger = spark.createDataFrame(
        [("t", 0, 9, 0, "a"), ("t", 0, 19, 1, "a"), ("t", 0, 4, 5, "old")], LOG + ", batch_id bigint, run string"
    )
    assert as_rows(offsets.marks_before(ledger, 1, "a")) == [("t", 0, 9)]
    assert as_rows(offsets.marks_before(ledger, 0, "a")) == [("t", 0, 4)]
    assert as_rows(offsets.marks_before(ledger, 0, "new")) == [("t", 0, 19)]


def test_skipped_ranges(spark, as_rows):
    records = log(spark, *[("t", p, o) for p in (0, 1) for o in range(2, 8)])
    assert as_rows(offsets.skipped_ranges(records, log(spark, ("t", 0, 4)))) == [("t", 0, 2, 4, 3)]


def test_lookup_beyond_the_broadcast_limit_gives_the_same(spark, as_rows):
    records = log(spark, *[("t", o % 5, o) for o in range(100)])
    marks = log(spark, *[("t", p, 10 * p) for p in range(5)]).withColumnRenamed("offset", "mark")
    small = lookup_join(records, marks, ["topic", "partition"])
    large = lookup_join(records, marks, ["topic", "partition"], max_bytes=20)
    assert as_rows(small) == as_rows(large)
    assert "ResolvedHint (strategy=broadcast)" in small._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()


def test_observed_counts_alongside_the_write(spark):
    counted, seen = offsets.observed(spark.range(10), "n", total=F.count(F.lit(1)), even=F.count_if(F.col("id") % 2 == 0))
    counted.write.format("noop").mode("overwrite").save()
    assert seen.get == {"total": 10, "even": 5}
