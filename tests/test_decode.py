import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relayframe.functions import times
from relayframe.operators import decode


def log(spark, *values, topic="t"):
    rows = [(topic, i, None if v is None else bytearray(v.encode())) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "topic string, offset bigint, value binary")


def schema(**fields):
    return T.StructType([T.StructField(n, *(spec if isinstance(spec, tuple) else (spec, True))) for n, spec in fields.items()])


def test_missing_and_null_fields(spark):
    required = schema(
        s=(T.StringType(), False),
        n=(T.LongType(), False),
        b=(T.BooleanType(), False),
        d=(T.DecimalType(10, 2), False),
        day=(T.DateType(), False),
        at=(T.TimestampType(), False),
        raw=(T.BinaryType(), False),
        list=(T.ArrayType(T.LongType()), False),
        map=(T.MapType(T.StringType(), T.LongType()), False),
        sub=(schema(x=(T.LongType(), False), y=T.LongType()), False),
        maybe=T.LongType(),
    )
    zeros = ("", 0, False, Decimal("0.00"), date(1, 1, 1), "0001-01-01 00:00:00", bytearray(b""), [], {}, (0, None), None)
    nulls = '{"s":null,"n":null,"at":null,"raw":null,"maybe":null,"extra":1}'
    rows = decode.project(log(spark, "{}", nulls, "", None), required)
    # Python cannot hold year 1 in every zone, so the time is compared as text.
    for row in rows.withColumn("at", F.col("at").cast("string")).collect():
        assert tuple(row) == zeros


def test_columns_follow_the_target(spark):
    target = schema(b=T.LongType(), a=T.StringType())
    df = decode.project(log(spark, '{"a":"x","b":1,"c":{"d":2}}'), target, keep=("offset",))
    assert df.columns == ["offset", "b", "a"]
    assert tuple(df.first()) == (0, 1, "x")


def test_nested_values(spark):
    target = schema(o=schema(x=T.LongType()), l=T.ArrayType(T.StringType()), m=T.MapType(T.StringType(), T.LongType()))
    row = decode.project(log(spark, '{"o":{"x":1},"l":["a"],"m":{"k":2}}'), target).first()
    assert (row["o"]["x"], row["l"], row["m"]) == (1, ["a"], {"k": 2})


def test_malformed_value_fails(spark):
    for value in ['{"n":', '{"n":"text"}']:
        with pytest.raises(Exception, match="(?i)malformed"):
            decode.project(log(spark, value), schema(n=T.LongType())).collect()


def test_quarantine_keeps_the_original_record(spark):
    target = schema(n=T.LongType(), t=T.TimestampType())
    records = log(spark, '{"n":1,"t":"2024-01-01T00:00:00Z"}', '{"n":', '{"n":2,"t":"yesterday"}', '{"n":"x"}')
    good, bad = decode.split_malformed(records, target, "rfc3339")
    assert [r["n"] for r in good.collect()] == [1]
    assert sorted(r["offset"] for r in bad.collect()) == [1, 2, 3]
    assert bad.columns == records.columns


def test_bytes_field(spark):
    values = ['{"b":"aGk="}', '{"b":{"x": [1, 2]}}', '{"b":12}', '{"b":"MTI="}', '{"b":null}', "{}", '{"b":true}']
    rows = decode.project(log(spark, *values), schema(b=T.BinaryType())).collect()
    got = [None if r["b"] is None else bytes(r["b"]) for r in rows]
    assert got == [b"hi", b'{"x": [1, 2]}', b"12", b"12", None, None, b"true"]


@pytest.mark.parametrize(
    "fmt, text", [("rfc3339", '"2024-01-02T03:04:05Z"'), ("timestamp", "1704164645"), ("timestamp-milli", "1704164645000")]
)
def test_time_formats(spark, fmt, text):
    for kind in (T.TimestampType(), T.TimestampNTZType()):
        df = decode.project(log(spark, f'{{"t":{text}}}'), schema(t=kind), decode.json_decoder(fmt))
        assert df.first()["t"] == datetime(2024, 1, 2, 3, 4, 5)


def test_bad_time_text_fails(spark):
    with pytest.raises(Exception, match="(?i)parse|cast"):
        decode.project(log(spark, '{"t":"yesterday"}'), schema(t=T.TimestampType()), decode.json_decoder("rfc3339")).collect()


def test_formats_by_name(tmp_path):
    assert callable(decode.make_decoder())
    assert callable(decode.make_decoder("json", time_format=""))
    with pytest.raises(ValueError):
        decode.make_decoder("xml")
    with pytest.raises(ValueError):
        decode.make_decoder("json", time_format="iso")
    file = tmp_path / "s.avsc"
    file.write_text('{"type":"record","name":"r","fields":[{"name":"a","type":"long"}]}')
    assert decode.avro_field_names(decode.schema_text(f"file://{file}")) == ["a"]
    assert callable(decode.make_decoder("avro", schemas={"t": f"file://{file}"}))


def test_avro_topic_without_schema_fails(spark):
    target = schema(a=T.LongType())
    with pytest.raises(Exception, match="no schema for topic t"):
        decode.project(log(spark, "x"), target, decode.avro_decoder({})).collect()


def test_avro_picks_the_topic_s_schema(spark, monkeypatch):
    """The Avro package is not installed; a stand-in parses the values as JSON of the same fields."""
    ddl = {"long": "bigint", "string": "string"}

    def from_avro(value, text):
        fields = json.loads(text)["fields"]
        return F.from_json(value.cast("string"), ", ".join(f"{f['name']} {ddl[f['type']]}" for f in fields))

    monkeypatch.setattr("pyspark.sql.avro.functions.from_avro", from_avro)
    schemas = {
        "t": '{"type":"record","name":"r","fields":[{"name":"a","type":"long"}]}',
        "u": '{"type":"record","name":"r","fields":[{"name":"a","type":"string"},{"name":"b","type":"string"}]}',
    }
    target = schema(a=T.LongType(), b=(T.StringType(), False))
    records = log(spark, '{"a":1}').unionByName(log(spark, '{"a":"2","b":"x"}', topic="u"))
    rows = decode.project(records, target, decode.make_decoder("avro", schemas=schemas)).collect()
    assert sorted(map(tuple, rows)) == [(1, ""), (2, "x")]
    with pytest.raises(Exception, match="no schema for topic v"):
        decode.project(log(spark, "{}", topic="v"), target, decode.make_decoder("avro", schemas=schemas)).collect()


def test_own_decoder(spark):
    def lengths(value, target):
        return F.struct(F.length(value).cast("bigint").alias("n"))

    rows = decode.project(log(spark, "abc", "de"), schema(n=T.LongType()), lengths).collect()
    assert [r["n"] for r in rows] == [3, 2]


def test_bytes_field_keeps_what_was_written(spark):
    raw = '{"z": 1, "a": 1.50,"m":1e3, "t":"\\u00e9, }"}'
    values = [f' {{ "other": {{"b":1}} ,"b" : {raw} , "c":[]}}', '{"b":1.00}', '{"b":-0.0e5}']
    rows = decode.project(log(spark, *values), schema(b=T.BinaryType())).collect()
    assert [bytes(r["b"]).decode() for r in rows] == [raw, "1.00", "-0.0e5"]


def test_permissive_decoding_needs_a_quarantine(spark):
    with pytest.raises(ValueError, match="quarantine"):
        decode.make_decoder("json", mode="PERMISSIVE")
    with pytest.raises(ValueError, match="split_malformed"):
        decode.project(log(spark, "{bad"), schema(id=T.LongType()), decode.json_decoder(mode="PERMISSIVE"))


def test_dates_have_the_time_format(spark):
    target = schema(d=T.DateType())
    for time_format, text in (("rfc3339", '"2024-03-01T00:00:00Z"'), (times.SECONDS, "1709251200"), (times.MILLIS, "1709251200000")):
        rows = decode.project(log(spark, f'{{"d":{text}}}'), target, decode.json_decoder(time_format)).collect()
        assert str(rows[0]["d"]) == "2024-03-01"
