"""Tables to topics, once."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relayframe.functions.text import split_table_name
from relayframe.operators.catalog import key_columns_of
from relayframe.operators.envelope import snapshot_headers, snapshot_messages
from relayframe.operators.routing import Routes, route_topic


@dataclass
class SnapshotTable:
    """A table to send: its ``schema.table`` name, rows and key columns."""

    name: str
    rows: DataFrame
    key_columns: Sequence[str] = ()
    zoned: Collection[str] = ()
    uuids: Collection[str] = ()


@dataclass
class SnapshotPlan:
    """How tables become messages."""

    condition: str = ""
    routes: Routes = ()
    prefix: str = ""
    total: bool = True
    host: str = ""
    port: int | str = ""
    database: str = ""
    ts_ms: int | None = None
    tables: list[SnapshotTable] = field(default_factory=list)

    def table_messages(self, table: SnapshotTable) -> DataFrame:
        return snapshot_messages(
            table.rows,
            table.key_columns,
            route_topic(F.lit(table.name), self.routes, self.prefix),
            snapshot_headers(table.name, self.host, self.port, self.database, self.ts_ms),
            self.condition,
            self.total,
            table.zoned,
            table.uuids,
        )

    def messages(self) -> DataFrame:
        """Messages of all tables, in one frame."""
        return reduce(DataFrame.unionByName, [self.table_messages(t) for t in self.tables])


def keyed_tables(frames: dict[str, DataFrame], primary_key_columns: DataFrame) -> list[SnapshotTable]:
    """Tables with their key columns looked up in the database's catalog."""
    return [
        SnapshotTable(name, rows, key_columns_of(primary_key_columns, *split_table_name(name)))
        for name, rows in frames.items()
    ]
