"""JSON texts in and out."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KEEP_NULLS = {"ignoreNullFields": "false"}


def object_json(names: Iterable[str]) -> Column:
    """The named columns as a JSON object: keys in order, nulls kept, ``{}`` for no column."""
    names = sorted(names)
    if not names:
        return F.lit("{}")
    return F.to_json(F.struct(*[F.col(f"`{n}`").alias(n) for n in names]), _KEEP_NULLS)


def map_json(entries: Column) -> Column:
    """An array of ``struct<name, variant>`` as a JSON object, keys in the array's order."""
    return F.to_json(F.map_from_entries(entries), _KEEP_NULLS)


def bytes_field(value: Column, raw: Column) -> Column:
    """A bytes field: null stays null, text is base64, anything else is its JSON text as it was written.

    ``value`` is the field as a variant, which tells its kind, and ``raw`` the same field read as text.
    """
    return (
        F.when(value.isNull() | F.is_variant_null(value), F.lit(None).cast("binary"))
        .when(F.schema_of_variant(value) == "STRING", F.unbase64(value.cast("string")))
        .when(_is_plain_number(value), value.cast("string").cast("binary"))
        .otherwise(raw.cast("binary"))
    )


def _is_plain_number(value: Column) -> Column:
    """Whole numbers are written in one way only, but for a zero, which may have a sign."""
    is_whole = F.schema_of_variant(value) == "BIGINT"
    return is_whole & (F.when(is_whole, F.try_variant_get(value, "$", "bigint")) != 0)


def needs_raw_text(value: Column) -> Column:
    """Whether a bytes field is something else than null, text or a plain number."""
    told = value.isNull() | F.is_variant_null(value) | (F.schema_of_variant(value) == "STRING") | _is_plain_number(value)
    return ~F.coalesce(told, F.lit(False))


def _raw_values(text: str | None, names: list[str]) -> list[str | None]:
    """The text of an object's members as it stands there; nulls for what is absent or not an object."""
    if text is None:
        return [None] * len(names)
    found: dict[str, str] = {}
    read, blank = json.JSONDecoder().raw_decode, re.compile(r"[ \t\r\n]*")
    try:
        at = blank.match(text or "").end()
        more = text is not None and text[at : at + 1] == "{" and text[blank.match(text, at + 1).end()] != "}"
        while more:
            name, at = read(text, blank.match(text, at + 1).end())
            start = blank.match(text, text.index(":", at) + 1).end()
            at = read(text, start)[1]
            found[name] = text[start:at]
            at = blank.match(text, at).end()
            more = text[at] == ","
    except (ValueError, IndexError):
        pass  # the typed parse of the same text reports it
    return [found.get(n) for n in names]


def raw_members(text: Column, names: Iterable[str]) -> Column:
    """The named members of a JSON object as they are written, as a struct of texts. Spark's own parsers
    write nested values and numbers anew, so this one goes through Arrow batches."""
    names = list(names)
    kind = T.StructType([T.StructField(n, T.StringType()) for n in names])

    @F.pandas_udf(kind)
    def read(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_raw_values(t, names) for t in texts], columns=names, dtype=object)

    return read(text)


def headers(pairs: Iterable[tuple[str, Column]]) -> Column:
    """Message headers in the given order."""
    return F.array(*[F.struct(F.lit(k).alias("key"), v.cast("binary").alias("value")) for k, v in pairs])


def headers_text(column: Column) -> Column:
    """Headers as ``k=v;k=v`` text, for reports and comparisons."""
    return F.array_join(
        F.transform(column, lambda h: F.concat(h["key"], F.lit("="), h["value"].cast("string"))), ";"
    )
