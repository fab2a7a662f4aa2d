"""Table rows as keyed JSON messages."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relayframe import __version__
from relayframe.functions import payload
from relayframe.functions.codecs import canonical_row


def strip_where(condition: str) -> str:
    """A condition may be given with its leading WHERE."""
    text = condition.strip()
    return text[5:].strip() if text[:5].upper() == "WHERE" and not text[5:6].isalnum() else text


def snapshot_rows(table: DataFrame, condition: str = "") -> DataFrame:
    text = strip_where(condition)
    return table.where(F.expr(text)) if text else table


def row_count(table: DataFrame, condition: str = "") -> DataFrame:
    return snapshot_rows(table, condition).agg(F.count(F.lit(1)).alias("n_rows"))


def with_total(rows: DataFrame) -> DataFrame:
    """Add the size of the whole set as ``total``, replacing a column of that name.

    A scalar subquery counts once and hands each task a literal; a window over everything would
    move every row into one task.
    """
    return rows.withColumn("total", rows.agg(F.count(F.lit(1))).scalar())


def now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def snapshot_headers(
    table: str, host: str = "", port: int | str = "", database: str = "", ts_ms: int | None = None
) -> Column:
    return payload.headers(
        [
            ("version", F.lit(__version__)),
            ("ts_ms", (now_millis() if ts_ms is None else F.lit(ts_ms)).cast("string")),
            ("host", F.lit(host)),
            ("port", F.lit(str(port))),
            ("database", F.lit(database)),
            ("table", F.lit(table)),
        ]
    )


def messages(
    rows: DataFrame, key_columns: Iterable[str], topic: Column, headers: Column
) -> DataFrame:
    """Rows as ``topic, key, value, headers``; the key is ``{}`` for a table without one."""
    return rows.select(
        topic.alias("topic"),
        payload.object_json(key_columns).cast("binary").alias("key"),
        payload.object_json(rows.columns).cast("binary").alias("value"),
        headers.alias("headers"),
    )


def snapshot_messages(
    table: DataFrame,
    key_columns: Sequence[str],
    topic: Column,
    headers: Column,
    condition: str = "",
    total: bool = True,
    zoned: Collection[str] = (),
    uuids: Collection[str] = (),
) -> DataFrame:
    """A table's rows under a condition, typed for JSON, as messages."""
    rows = snapshot_rows(table, condition)
    if total:
        rows = with_total(rows)
    return messages(canonical_row(rows, zoned, uuids), key_columns, topic, headers)
