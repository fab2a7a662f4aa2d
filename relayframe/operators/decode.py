"""Message values onto a target table's columns."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relayframe.functions.payload import bytes_field, needs_raw_text, raw_members
from relayframe.functions.times import MILLIS, RFC3339, TIME_FORMATS, decode_time

# A decoder turns (value, target) into a struct column with the target's fields.
Decoder = Callable[[Column, T.StructType], Column]

CORRUPT = "_corrupt"

# What a missing or null field becomes in a column that cannot hold null.
_ZEROS = {
    T.StringType: "",
    T.BinaryType: b"",
    T.BooleanType: False,
    T.ByteType: 0,
    T.ShortType: 0,
    T.IntegerType: 0,
    T.LongType: 0,
    T.FloatType: 0.0,
    T.DoubleType: 0.0,
    T.DecimalType: Decimal(0),
    T.DateType: "0001-01-01",
    T.TimestampNTZType: "0001-01-01 00:00:00",
}


def _is_time(data_type: T.DataType) -> bool:
    """Columns whose values have the configured time format; dates do as well."""
    return isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType))


def _wire_type(data_type: T.DataType, time_format: str) -> T.DataType:
    """How a target field looks inside the JSON text."""
    if _is_time(data_type):
        return T.StringType() if time_format == RFC3339 else T.LongType()
    if isinstance(data_type, T.BinaryType):
        return T.VariantType()
    return data_type


def _from_wire(col: Column, data_type: T.DataType, time_format: str, strict: bool, raw: Column | None = None) -> Column:
    if _is_time(data_type):
        return decode_time(col, time_format, strict).cast(data_type)
    if isinstance(data_type, T.BinaryType):
        return bytes_field(col, raw)
    return col


def json_decoder(time_format: str = MILLIS, mode: str = "FAILFAST") -> Decoder:
    """JSON values. A malformed one fails the query, or under PERMISSIVE fills the ``_corrupt`` field."""
    if time_format not in TIME_FORMATS:
        raise ValueError(f"invalid time_format: {time_format}")
    strict = mode.upper() == "FAILFAST"

    def decode(value: Column, target: T.StructType) -> Column:
        wire = [T.StructField(f.name, _wire_type(f.dataType, time_format), True) for f in target.fields]
        options = {"mode": mode}
        if not strict:
            wire.append(T.StructField(CORRUPT, T.StringType(), True))
            options["columnNameOfCorruptRecord"] = CORRUPT
        parsed = F.from_json(value.cast("string"), T.StructType(wire), options)
        if strict and [f.dataType for f in wire] == [f.dataType for f in target.fields]:
            return parsed
        written = [f.name for f in target.fields if isinstance(f.dataType, T.BinaryType)]
        # Only records with such a field are read as they are written; others pass as nulls.
        odd = reduce(Column.__or__, [needs_raw_text(parsed[n]) for n in written]) if written else None
        raw = raw_members(F.when(odd, value.cast("string")), written) if written else None
        fields = [
            _from_wire(
                parsed[f.name],
                f.dataType,
                time_format,
                strict,
                raw[f.name] if isinstance(f.dataType, T.BinaryType) else None,
            ).alias(f.name)
            for f in target.fields
        ]
        if not strict:
            broken = [parsed[CORRUPT]]
            if time_format == RFC3339:
                # A time text that does not parse spoils its record as well.
                broken += [
                    F.when(parsed[n].isNotNull() & decode_time(parsed[n], RFC3339, False).isNull(), value.cast("string"))
                    for n in [f.name for f in target.fields if _is_time(f.dataType)]
                ]
            fields.append(F.coalesce(*broken).alias(CORRUPT))
        return F.struct(*fields)

    decode.json_time_format = time_format
    decode.permissive = not strict
    return decode


def avro_field_names(schema: str) -> list[str]:
    return [field["name"] for field in json.loads(schema)["fields"]]


def avro_decoder(schemas: Mapping[str, str], topic: Column | None = None) -> Decoder:
    """Avro values by per-topic schema text; a topic without one fails the query.

    One CASE over the topics reads the log once, whatever their number. Needs Spark's Avro package.
    """
    from pyspark.sql.avro.functions import from_avro

    topic = F.col("topic") if topic is None else topic

    def decode(value: Column, target: T.StructType) -> Column:
        decoded = F.raise_error(F.concat(F.lit("no schema for topic "), topic)).cast(target)
        for name, schema in schemas.items():
            present = set(avro_field_names(schema))
            parsed = from_avro(value, schema)
            fields = [
                (parsed[f.name] if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in target.fields
            ]
            decoded = F.when(topic == name, F.struct(*fields)).otherwise(decoded)
        return decoded

    return decode


def schema_text(source: str) -> str:
    """Avro schema text as given, or read from a ``file://`` location."""
    if not source.startswith("file://"):
        return source
    with open(source.removeprefix("file://"), encoding="utf-8") as file:
        return file.read()


def make_decoder(
    fmt: str = "json",
    *,
    time_format: str = MILLIS,
    mode: str = "FAILFAST",
    schemas: Mapping[str, str] | None = None,
) -> Decoder:
    """Decoder by format name. Malformed records fail the query; a sink's quarantine sets them aside."""
    if mode.upper() != "FAILFAST":
        raise ValueError(f"mode {mode} would store malformed records as empty rows; give the sink a quarantine instead")
    if fmt in ("", "json"):
        return json_decoder(time_format or MILLIS, mode)
    if fmt == "avro":
        return avro_decoder({t: schema_text(s) for t, s in (schemas or {}).items()})
    raise ValueError(f"unknown format: {fmt!r}, expected json or avro")


def zero(data_type: T.DataType) -> Column:
    """The value an absent field takes where null is not allowed."""
    if isinstance(data_type, T.TimestampType):
        return F.expr("TIMESTAMP '0001-01-01 00:00:00Z'")
    if isinstance(data_type, T.ArrayType):
        return F.array().cast(data_type)
    if isinstance(data_type, T.MapType):
        return F.create_map().cast(data_type)
    if isinstance(data_type, T.StructType):
        fields = [F.lit(None).cast(f.dataType) if f.nullable else zero(f.dataType) for f in data_type.fields]
        return F.struct(*[field.alias(f.name) for field, f in zip(fields, data_type.fields)])
    return F.lit(_ZEROS[type(data_type)]).cast(data_type)


def zero_filled(row: Column, target: T.StructType) -> list[Column]:
    """Fields of a decoded row, with zero values where the target allows no null."""
    return [
        (row[f.name] if f.nullable else F.coalesce(row[f.name], zero(f.dataType))).alias(f.name)
        for f in target.fields
    ]


def project(
    log: DataFrame, target: T.StructType, decoder: Decoder | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Records as rows of the target table: its columns only, in its order."""
    decoder = decoder or json_decoder()
    if getattr(decoder, "permissive", False):
        raise ValueError("a permissive decoder's malformed records need split_malformed")
    return log.select(*keep, decoder(F.col("value"), target).alias("row")).select(
        *keep, *zero_filled(F.col("row"), target)
    )


def split_malformed(
    log: DataFrame, target: T.StructType, time_format: str = MILLIS, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """Decodable records as target rows, and the others unchanged, for a quarantine table."""
    row = json_decoder(time_format, "PERMISSIVE")(F.col("value"), target)
    decoded = log.withColumn("row", row)
    good = decoded.where(F.col(f"row.{CORRUPT}").isNull()).select(*keep, *zero_filled(F.col("row"), target))
    bad = decoded.where(F.col(f"row.{CORRUPT}").isNotNull()).select(log.columns)
    return good, bad
