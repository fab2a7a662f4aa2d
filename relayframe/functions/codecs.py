"""Source values in the form messages carry them."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relayframe.functions.times import rfc3339_text

# What an infinite time becomes.
TIME_INFINITY = 2**63 - 1
TIME_NEG_INFINITY = -(2**63)


def uuid_text(raw: Column) -> Column:
    """16 bytes as lowercase 8-4-4-4-12 text."""
    digits = F.lower(F.hex(raw))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digits, start, length) for start, length in cuts])


def numeric_text(value: Column) -> Column:
    """Exact decimals travel as text, never as floats."""
    return value.cast("string")


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def epoch_millis_from_text(text: Column) -> Column:
    """Zone-less time text to epoch milliseconds; infinities become the extreme integers."""
    return (
        F.when(text == "infinity", F.lit(TIME_INFINITY))
        .when(text == "-infinity", F.lit(TIME_NEG_INFINITY))
        .otherwise(F.unix_millis(F.to_timestamp(text)))
    )


def date_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd'T'00:00:00'Z'")


def canonical(col: Column, data_type: T.DataType, zoned: bool = False, uuid: bool = False) -> Column:
    """One value of a source table in message form."""
    if isinstance(data_type, T.DecimalType):
        return numeric_text(col)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return rfc3339_text(col) if zoned else epoch_millis(col)
    if isinstance(data_type, T.DateType):
        return date_text(col)
    if isinstance(data_type, T.BinaryType) and uuid:
        return uuid_text(col)
    return col


def canonical_row(
    df: DataFrame, zoned: Collection[str] = (), uuids: Collection[str] = ()
) -> DataFrame:
    """All columns of a table in message form, driven by the frame's own types."""
    return df.select(
        *[
            canonical(F.col(f"`{f.name}`"), f.dataType, f.name in zoned, f.name in uuids).alias(f.name)
            for f in df.schema.fields
        ]
    )
