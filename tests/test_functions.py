from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relayframe.functions import codecs, options, payload, text, times


def one(spark, col, **values):
    df = spark.range(1)
    for name, value in values.items():
        df = df.withColumn(name, value if isinstance(value, type(F.lit(1))) else F.lit(value))
    return df.select(col.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "interval, expected",
    [
        ("1h", "2024-05-15 10:00:00"),
        ("7h", "2024-05-15 08:00:00"),
        (timedelta(days=7), "2024-05-13 00:00:00"),
        ("24h", "2024-05-15 00:00:00"),
        ("500ms", "2024-05-15 10:20:30"),
    ],
)
def test_bucket_counts_from_year_one(spark, interval, expected):
    ts = F.lit("2024-05-15 10:20:30.75").cast("timestamp")
    assert one(spark, times.bucket(ts, interval)) == expected
    width = timedelta(microseconds=times.duration_micros(interval))
    moment = datetime(2024, 5, 15, 10, 20, 30, 750000)
    floor = moment - (moment - datetime(1, 1, 1)) % width
    assert floor.strftime(times.BUCKET_STRPTIME) == expected


def test_bucket_before_1970(spark):
    assert one(spark, times.bucket(F.lit("1960-02-03 04:05:06").cast("timestamp"), "1h")) == "1960-02-03 04:00:00"


def test_durations_and_sizes():
    assert times.duration_micros("1h30m") == 5_400_000_000
    assert times.duration_micros(2.5) == 2_500_000
    with pytest.raises(ValueError):
        times.duration_micros("1 hour")
    assert options.size_bytes("10GB") == 10 * 1024**3
    assert options.size_bytes("1.5K") == 1536
    with pytest.raises(ValueError):
        options.size_bytes("10")
    assert options.topic_settings()["retention.ms"] == str(168 * 3600 * 1000)
    assert options.topic_settings(part_retention_size="1MiB")["retention.bytes"] == "1048576"


def test_bucket_bound_is_checked():
    assert times.bucket_bound(datetime(2024, 1, 2, 3, 4, 5)) == "2024-01-02 03:04:05"
    with pytest.raises(ValueError):
        times.bucket_bound("2024-01-02")


def test_decode_time_formats(spark):
    expected = datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, times.decode_time(F.lit("2024-01-02T05:04:05+02:00"), times.RFC3339)) == expected
    assert one(spark, times.decode_time(F.lit(1704164645), times.SECONDS)) == expected
    assert one(spark, times.decode_time(F.lit(1704164645000), times.MILLIS)) == expected
    with pytest.raises(ValueError):
        times.decode_time(F.lit(0), "other")


@pytest.mark.parametrize("fraction, shown", [("", ""), (".250", ".25"), (".000001", ".000001")])
def test_rfc3339_text(spark, fraction, shown):
    ts = F.lit(f"2024-01-02 03:04:05{fraction}").cast("timestamp")
    assert one(spark, times.rfc3339_text(ts)) == f"2024-01-02T03:04:05{shown}Z"


def test_infinite_times(spark):
    assert one(spark, codecs.epoch_millis_from_text(F.lit("infinity"))) == 2**63 - 1
    assert one(spark, codecs.epoch_millis_from_text(F.lit("-infinity"))) == -(2**63)
    assert one(spark, codecs.epoch_millis_from_text(F.lit("2024-01-02 03:04:05.678"))) == 1704164645678


def test_canonical_row(spark):
    schema = T.StructType(
        [
            T.StructField("id", T.BinaryType()),
            T.StructField("amount", T.DecimalType(30, 2)),
            T.StructField("at", T.TimestampType()),
            T.StructField("zoned", T.TimestampType()),
            T.StructField("day", T.DateType()),
            T.StructField("n", T.IntegerType()),
        ]
    )
    at = datetime(2024, 1, 2, 3, 4, 5, 678000)
    raw = bytearray(range(16))
    big = Decimal("1234567890123456789012345678.50")
    df = spark.createDataFrame([(raw, big, at, at, at.date(), None)], schema)
    row = codecs.canonical_row(df, zoned=["zoned"], uuids=["id"]).first()
    assert row["id"] == "00010203-0405-0607-0809-0a0b0c0d0e0f"
    assert row["amount"] == "1234567890123456789012345678.50"
    assert row["at"] == 1704164645678
    assert row["zoned"] == "2024-01-02T03:04:05.678Z"
    assert row["day"] == "2024-01-02T00:00:00Z"
    assert row["n"] is None


def test_object_json_sorts_and_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, 'q"\n')], "b int, a string, c string")
    assert df.select(payload.object_json(df.columns)).first()[0] == '{"a":null,"b":1,"c":"q\\"\\n"}'
    assert df.select(payload.object_json([])).first()[0] == "{}"


def test_not_a_number_is_text_in_json(spark):
    df = spark.createDataFrame([(float("nan"), float("inf"))], "a double, b double")
    assert df.select(payload.object_json(df.columns)).first()[0] == '{"a":"NaN","b":"Infinity"}'


def test_names(spark):
    assert tuple(one(spark, text.split_qualified(F.lit("a.b.c")))) == ("a", "b.c")
    with pytest.raises(Exception, match="table without a schema"):
        one(spark, text.split_qualified(F.lit("orders")))
    with pytest.raises(ValueError):
        text.split_table_name("orders")
    assert one(spark, text.ends_with_any(F.lit("x.public.h"), ["a", "public.h"])) is True
