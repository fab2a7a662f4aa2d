"""Row-change log to topics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from relayframe.operators import changes as ch
from relayframe.operators.routing import Routes

# Columns that a query spells out. It bounds the size of generated code; beyond it versions are looked up.
# What a change becomes does not depend on it.
COLUMNS_SPELLED_OUT = 400


@dataclass
class ChangeFeed:
    """Which changes are sent, and how."""

    tables: Sequence[str] | None = None
    skip_deletes: bool = False
    heartbeat: str = ch.HEARTBEAT_SUFFIX
    routes: Routes = ()
    prefix: str = ""
    unchanged: str = "null"
    host: str = ""
    port: int | str = ""
    database: str = ""
    ts_ms: int | None = None

    def selected(self, changes: DataFrame) -> DataFrame:
        """Row changes of the subscribed tables. Plain filters: they reach the scan."""
        if self.tables:
            changes = ch.subscribed(changes, self.tables)
        changes = ch.without_relations(ch.row_changes(changes), [self.heartbeat])
        return ch.without_deletes(changes) if self.skip_deletes else changes

    def messages(self, changes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        headers = ch.change_headers(self.host, self.port, self.database, self.ts_ms)
        return ch.change_messages(
            self.selected(changes), headers, self.routes, self.prefix, self.unchanged, keep
        )

    def raw_messages(
        self,
        raw: DataFrame,
        relations: DataFrame,
        keep: tuple[str, ...] = (),
        columns_spelled_out: int = COLUMNS_SPELLED_OUT,
    ) -> DataFrame:
        """Messages of raw row changes, described by relation rows. The log is read once.

        The columns of few relations are spelled out in the query; those of many are looked up by relation.
        Filters on names become filters on relation ids, which reach the scan.
        """
        known = ch.versions_of(relations)
        wanted = {i: versions for i, versions in known.items() if any(map(self._wants, versions))}
        others = sorted(set(known) - set(wanted))
        rows = self._rows(raw)
        # Unknown ids stay, so that they fail the query.
        rows = rows.where(~F.col("relation_id").isin(others)) if others else rows
        # A renamed table can be wanted in one version and not in another.
        mixed = not all(self._wants(v) for versions in wanted.values() for v in versions)
        width = sum(len(v["columns"]) for versions in wanted.values() for v in versions)
        if width > columns_spelled_out:
            return self._looked_up(rows, relations, keep, mixed)
        return self._of_wanted(ch.known_messages, rows, wanted, keep, mixed)

    def looked_up_messages(self, raw: DataFrame, relations: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """The same without a look at the relations when the query is built, for relations that change."""
        return self._looked_up(self._rows(raw), relations, keep, True)

    def _looked_up(self, rows: DataFrame, relations: DataFrame, keep: tuple[str, ...], mixed: bool) -> DataFrame:
        return self._of_wanted(ch.looked_up_messages, rows, relations, keep, mixed)

    def _rows(self, raw: DataFrame) -> DataFrame:
        rows = ch.row_changes(raw)
        rows = rows.drop("relation") if "relation" in rows.columns else rows
        return ch.without_deletes(rows) if self.skip_deletes else rows

    def _of_wanted(self, decode, rows: DataFrame, relations, keep: tuple[str, ...], mixed: bool) -> DataFrame:
        headers = ch.change_headers(self.host, self.port, self.database, self.ts_ms)
        kept = (*keep, "relation") if mixed and "relation" not in keep else keep
        messages = decode(rows, relations, headers, self.routes, self.prefix, kept, self.unchanged)
        if not mixed:
            return messages
        if self.tables:
            messages = ch.subscribed(messages, self.tables)
        messages = ch.without_relations(messages, [self.heartbeat])
        return messages if "relation" in keep else messages.drop("relation")

    def _wants(self, relation: Row) -> bool:
        name = f"{relation['namespace']}.{relation['name']}"
        return (not self.tables or name in self.tables) and not name.endswith(self.heartbeat)


def in_log_order(messages: DataFrame, position: str = "lsn_start") -> DataFrame:
    """Messages so dealt that those of one key are sent by one task, in the order of the log. A hot table
    is spread over its keys."""
    return messages.repartition("topic", "key").sortWithinPartitions("topic", "key", position)
