"""Session settings."""

import pyarrow as pa
from pyspark.sql import functions as F

from relayframe.session import BATCH_LIMIT, share_package


def test_arrow_batches_are_bounded_by_bytes(spark):
    """Sets of shingles are wide rows; a task must not hold 10,000 of them, or 64 MB, at once."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["bytes"])

    def most():
        wide = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("x"), F.lit(100_000)).alias("t"))
        return wide.mapInArrow(sizes, "bytes long").agg(F.max("bytes")).first()[0]

    spark.conf.unset(BATCH_LIMIT)
    share_package(spark)
    assert most() < 9 << 20
    spark.conf.set(BATCH_LIMIT, "1m")
    share_package(spark)  # what the session says stays
    assert most() < 2 << 20
    spark.conf.unset(BATCH_LIMIT)
