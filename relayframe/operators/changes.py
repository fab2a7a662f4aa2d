"""Row-change logs: filters, relation lookup, typed tuples and messages."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from relayframe import __version__
from relayframe.functions import binary, codecs, payload
from relayframe.functions.text import ends_with_any, qualify
from relayframe.functions.times import rfc3339_text
from relayframe.operators.envelope import now_millis
from relayframe.operators.routing import Routes, route_topic
from relayframe.session import lookup_join

ROW_OPS = ("I", "U", "D")
# A message that describes a relation, in logs that hold those as well.
RELATION_OP = "R"
# Fixed value: the name of the table that heartbeats are written to unless one is configured.
HEARTBEAT_SUFFIX = "public.pipe_health"
# A relation version without a position holds from the beginning.
_FIRST = -(2**63)

# Type numbers of the source database's catalog.
OID = {
    "bool": 16,
    "bytea": 17,
    "int8": 20,
    "int2": 21,
    "int4": 23,
    "text": 25,
    "oid": 26,
    "json": 114,
    "float4": 700,
    "float8": 701,
    "varchar": 1043,
    "date": 1082,
    "timestamp": 1114,
    "timestamptz": 1184,
    "numeric": 1700,
    "uuid": 2950,
    "jsonb": 3802,
}
_INTEGERS = ("int2", "int4", "int8", "oid")
_FLOATS = ("float4", "float8")
_TEXTS = ("text", "varchar")
_KEEP_NULLS = {"ignoreNullFields": "false"}


# -- filters ---------------------------------------------------------------------------------


def subscribed(changes: DataFrame, tables: Iterable[str]) -> DataFrame:
    return changes.where(F.col("relation").isin(*tables))


def row_changes(changes: DataFrame) -> DataFrame:
    """Inserts, updates and deletes; other messages only move the position."""
    return changes.where(F.col("op").isin(*ROW_OPS))


def without_deletes(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("op") != "D")


def without_relations(changes: DataFrame, suffixes: Sequence[str] = (HEARTBEAT_SUFFIX,)) -> DataFrame:
    """Drop relations whose qualified name ends in one of the suffixes."""
    return changes.where(~ends_with_any(F.col("relation"), suffixes))


def since_position(changes: DataFrame, position: int | None) -> DataFrame:
    return changes if position is None else changes.where(F.col("lsn_start") >= position)


def next_position(changes: DataFrame) -> DataFrame:
    """End of the last message of any kind, where the next read starts."""
    return changes.agg(F.max("lsn_end").alias("position"))


def lsn_text(lsn: Column) -> Column:
    """Log position as two hexadecimal halves."""
    return F.concat(F.hex(F.shiftrightunsigned(lsn, 32)), F.lit("/"), F.hex(lsn.bitwiseAND(F.lit(0xFFFFFFFF))))


# -- tuples ----------------------------------------------------------------------------------


def relation_versions(relations: DataFrame) -> DataFrame:
    """One row per relation id with its ``versions`` in order: names, columns, and ``since``, the position
    from which they hold. A relation is sent again after each change to its table. Two different versions
    from one position are ambiguous and fail the query."""
    since = F.col("since").cast("bigint") if "since" in relations.columns else F.lit(None).cast("bigint")
    version = F.struct(F.coalesce(since, F.lit(_FIRST)).alias("since"), "namespace", "name", "columns")
    versions = F.sort_array(F.collect_set(version))
    grouped = relations.groupBy("relation_id").agg(versions.alias("versions"))
    clash = F.size(F.array_distinct(F.col("versions.since"))) < F.size("versions")
    told = F.raise_error(F.concat(F.lit("ambiguous versions of relation id "), F.col("relation_id").cast("string")))
    return grouped.select("relation_id", F.when(clash, told).otherwise(F.col("versions")).alias("versions"))


def describe(raw: DataFrame, relations: DataFrame) -> DataFrame:
    """Raw messages with relation names and self-describing columns, each by the relation version that
    holds at its position.

    A delete carries its old row and anything else its new one. A row change whose relation is
    unknown fails the query.
    """
    current = F.try_element_at(F.filter("versions", lambda v: v["since"] <= F.col("lsn_start")), F.lit(-1))
    joined = (
        lookup_join(raw, relation_versions(relations), ["relation_id"])
        .withColumn("_relation", current)
        .select("*", "_relation.namespace", "_relation.name", "_relation.columns")
    )
    known = ~F.col("op").isin(*ROW_OPS) | F.col("columns").isNotNull()
    unknown = F.raise_error(F.concat(F.lit("no relation is described by id "), F.col("relation_id").cast("string")))
    picked = _picked()
    cols = F.transform(
        F.arrays_zip(F.col("columns").alias("meta"), picked.alias("cell")),
        lambda c: F.struct(
            c["meta"]["name"].alias("name"),
            c["meta"]["oid"].alias("oid"),
            c["meta"]["is_key"].alias("is_key"),
            c["cell"]["kind"].alias("kind"),
            c["cell"]["data"].alias("data"),
        ),
    )
    return joined.select(
        "lsn_start",
        (F.col("lsn_start") + F.col("length")).alias("lsn_end"),
        "op",
        "relation_id",
        F.when(known, qualify(F.col("namespace"), F.col("name"))).otherwise(unknown).alias("relation"),
        F.when(~known, unknown).when(F.size(picked) > F.size("columns"), _too_long()).otherwise(cols).alias("cols"),
    )


def _picked() -> Column:
    return F.when(F.col("op") == "D", F.col("old_tuple")).otherwise(F.col("new_tuple"))


def _too_long() -> Column:
    told = F.concat(F.lit("more values than columns in a change of relation id "), F.col("relation_id").cast("string"))
    return F.raise_error(told)


def _oid_in(oid: Column, names: Iterable[str]) -> Column:
    return oid.isin(*[OID[n] for n in names])


# How a text-format value is read, by type; every other type stays text.
_TEXT_TYPED: list[tuple[Sequence[str], Callable[[Column], Column]]] = [
    (_INTEGERS, lambda text: text.cast("bigint")),
    (["bool"], lambda text: text.isin("t", "true")),
    (_FLOATS, lambda text: text.cast("double")),
    (["timestamp"], codecs.epoch_millis_from_text),
    (["timestamptz"], lambda text: rfc3339_text(F.to_timestamp(text))),
    (["date"], lambda text: codecs.date_text(F.to_date(text))),
    (["json", "jsonb"], F.parse_json),
    (["bytea"], lambda text: F.base64(F.unhex(F.substring(text, 3, 2**31 - 1)))),
]

# How a binary-format value is read, by type, so that it is what its text-format value would be.
_BINARY_TYPED: list[tuple[Sequence[str], Callable[[Column], Column]]] = [
    (["int2", "int4", "int8"], binary.signed),
    (["oid"], binary.unsigned),
    (["bool"], lambda data: F.hex(data) == "01"),
    (["float4"], binary.float4),
    (["float8"], binary.float8),
    (["numeric"], binary.numeric_text),
    (["uuid"], codecs.uuid_text),
    (["timestamp"], binary.timestamp_millis),
    (["timestamptz"], binary.timestamptz_text),
    (["date"], binary.date_text),
    (["bytea"], F.base64),
    (["json"], lambda data: F.parse_json(data.cast("string"))),
    # The first byte is a version.
    (["jsonb"], lambda data: F.parse_json(F.substring(data, 2, 2**31 - 1).cast("string"))),
    (_TEXTS, lambda data: data.cast("string")),
]


def _refused(oid: Column) -> Column:
    return F.raise_error(F.concat(F.lit("binary value of type "), oid.cast("string")))


def _json_text(value: Column) -> Column:
    """A value as JSON text; nulls are ``null``."""
    member = F.to_json(F.struct(value.alias("v")), _KEEP_NULLS)  # {"v":...}
    return F.substr(member, F.lit(6), F.length(member) - 6)


_TYPED_TEXT_OIDS = [name for names, _ in _TEXT_TYPED for name in names]


def _text_json(oid: Column, data: Column) -> Column:
    """JSON text of a text-format value."""
    text = data.cast("string")
    value = F.when(~_oid_in(oid, _TYPED_TEXT_OIDS), _json_text(text))
    for names, read in _TEXT_TYPED:
        # Whole numbers and booleans are their own JSON text.
        plain = names is _INTEGERS or "bool" in names
        value = value.when(
            _oid_in(oid, names), F.coalesce(read(text).cast("string"), F.lit("null")) if plain else _json_text(read(text))
        )
    return value


def _binary_json(oid: Column, data: Column) -> Column:
    """JSON text of a binary-format value."""
    value = F
    for names, read in _BINARY_TYPED:
        value = value.when(_oid_in(oid, names), _json_text(read(data)))
    return value.otherwise(_refused(oid))


def cell_json(cell: Column, oid: Column) -> Column:
    """JSON text of one column's value: null for nulls and for unchanged out-of-line values."""
    return (
        F.when(cell["kind"] == "t", _text_json(oid, cell["data"]))
        .when(cell["kind"] == "b", _binary_json(oid, cell["data"]))
        .otherwise("null")
    )


def _object(members: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))


def tuple_json(cols: Column, unchanged: str = "null") -> Column:
    """A change's columns as a JSON object with keys in order.

    ``unchanged="omit"`` leaves out values the source did not resend instead of writing null.
    """
    if unchanged not in ("null", "omit"):
        raise ValueError("unchanged must be 'null' or 'omit'")
    if unchanged == "omit":
        cols = F.filter(cols, lambda c: c["kind"] != "u")
    # Structs sort by their first field, the name.
    return _object(
        F.transform(F.sort_array(cols), lambda c: F.concat(_json_text(c["name"]), F.lit(":"), cell_json(c, c["oid"])))
    )


def key_json(cols: Column) -> Column:
    return tuple_json(F.filter(cols, lambda c: c["is_key"]))


# -- relations as rows -----------------------------------------------------------------------


def decode_plans(relations: DataFrame) -> DataFrame:
    """``relation_id, plans``: for each version its position, name, number of columns, and the members of a
    value and of a key in order: JSON name, place in the tuple, type."""

    def members(columns: Column) -> Column:
        return F.sort_array(columns)

    def placed(c: Column, i: Column) -> Column:
        text = F.concat(_json_text(c["name"]), F.lit(":"))
        return F.struct(
            c["name"].alias("name"), text.alias("text"), i.alias("at"), c["oid"].alias("oid"), c["is_key"].alias("is_key")
        )

    def plan(v: Column) -> Column:
        every = members(F.transform(v["columns"], placed))
        return F.struct(
            v["since"].alias("since"),
            qualify(v["namespace"], v["name"]).alias("relation"),
            F.size(v["columns"]).alias("width"),
            every.alias("members"),
            F.filter(every, lambda m: m["is_key"]).alias("keys"),
        )

    return relation_versions(relations).select("relation_id", F.transform("versions", plan).alias("plans"))


def looked_up_messages(
    raw: DataFrame,
    relations: DataFrame,
    headers: Column,
    routes: Routes = (),
    prefix: str = "",
    keep: tuple[str, ...] = (),
    unchanged: str = "null",
) -> DataFrame:
    """Raw row changes as messages, their relation versions looked up by id and position.

    One scan and one plan of the same size for any number of tables and columns. A change of an unknown
    relation fails the query, as does a tuple longer than the version that holds at its position.
    """
    if unchanged not in ("null", "omit"):
        raise ValueError("unchanged must be 'null' or 'omit'")
    current = F.try_element_at(F.filter("plans", lambda p: p["since"] <= F.col("lsn_start")), F.lit(-1))
    rows = lookup_join(raw, decode_plans(relations), ["relation_id"]).select("*", current.alias("_plan"), _picked().alias("_row"))
    unknown = F.raise_error(F.concat(F.lit("no relation is described by id "), F.col("relation_id").cast("string")))
    name = (
        F.when(F.col("_plan").isNull(), unknown)
        .when(F.size("_row") > F.col("_plan.width"), _too_long())
        .otherwise(F.col("_plan.relation"))
    )

    def json_of(members: str, unchanged: str) -> Column:
        def member(m: Column) -> Column:
            cell = F.get(F.col("_row"), m["at"])
            text = F.concat(m["text"], cell_json(cell, m["oid"]))
            return text if unchanged == "null" else F.when(~cell["kind"].eqNullSafe(F.lit("u")), text)

        return _object(F.transform(F.col(members), member))

    return rows.select("*", name.alias("relation")).select(
        *keep,
        route_topic(F.col("relation"), routes, prefix).alias("topic"),
        json_of("_plan.keys", "null").cast("binary").alias("key"),
        json_of("_plan.members", unchanged).cast("binary").alias("value"),
        headers.alias("headers"),
    )


def relations_in_log(changes: DataFrame) -> DataFrame:
    """Relation rows of a log that holds them between its changes, each from its position on."""
    sent = changes.where(F.col("op") == RELATION_OP)
    return sent.select("relation_id", "relation.namespace", "relation.name", "relation.columns", F.col("lsn_start").alias("since"))


# -- known relations -------------------------------------------------------------------------


def _reader(table: Sequence[tuple[Sequence[str], Callable[[Column], Column]]], oid: int):
    return next((read for names, read in table if oid in [OID[n] for n in names]), None)


def _known_value(cell: Column, oid: int) -> Column:
    """Value of a column whose type is known when the query is built."""
    text, of_text, of_bytes = cell["data"].cast("string"), _reader(_TEXT_TYPED, oid), _reader(_BINARY_TYPED, oid)
    return F.when(cell["kind"] == "t", of_text(text) if of_text else text).when(
        cell["kind"] == "b", of_bytes(cell["data"]) if of_bytes else _refused(F.lit(oid))
    )


def _known_json(
    picked: Column, columns: Sequence[Row], keys_only: bool = False, unchanged: str = "null"
) -> Column:
    cells = {c["name"]: (F.get(picked, i), c["oid"]) for i, c in enumerate(columns) if c["is_key"] or not keys_only}
    if not cells:
        return F.lit("{}")
    values = {n: _known_value(cell, oid) for n, (cell, oid) in cells.items()}
    if unchanged == "null":
        return F.to_json(F.struct(*[values[n].alias(n) for n in sorted(values)]), _KEEP_NULLS)
    # Members one by one: those that are null here, not resent, are left out by the join.
    members = []
    for n in sorted(values):
        named = F.concat(F.lit(json.dumps(n, ensure_ascii=False) + ":"), _json_text(values[n]))
        members.append(F.when(~cells[n][0]["kind"].eqNullSafe(F.lit("u")), named))
    return _object(F.array(*members))


def versions_of(relations: DataFrame) -> dict[int, list[Row]]:
    """Relation rows on the driver, by id and in order of the position from which they hold. There is a
    row for each table of the source and each change to its columns."""
    found: dict[int, list[Row]] = {}
    for r in relation_versions(relations).collect():
        found[r["relation_id"]] = list(r["versions"])
    return found


def known_messages(
    raw: DataFrame,
    relations: Mapping[int, Sequence[Row]],
    headers: Column,
    routes: Routes = (),
    prefix: str = "",
    keep: tuple[str, ...] = (),
    unchanged: str = "null",
) -> DataFrame:
    """Raw row changes as messages, for relation versions known when the query is built.

    One pass with the columns of each version spelled out: nothing is joined, and every value is
    decoded by compiled code instead of per-cell lambdas.
    """
    if unchanged not in ("null", "omit"):
        raise ValueError("unchanged must be 'null' or 'omit'")
    unknown = F.raise_error(F.concat(F.lit("no relation is described by id "), F.col("relation_id").cast("string")))

    def by_relation(of: Callable[[Row], Column]) -> Column:
        value = F
        for relation_id, versions in relations.items():
            # The latest version first: a change takes the last one at or before its position.
            for v in reversed(versions):
                holds = F.col("relation_id") == relation_id
                if v["since"] > _FIRST:
                    holds &= F.col("lsn_start") >= v["since"]
                value = value.when(holds, of(v))
        return value.otherwise(unknown) if relations else unknown.cast("string")

    def named_if_fitting(r: Row) -> Column:
        too_long = F.size("_row") > len(r["columns"])
        return F.when(too_long, _too_long()).otherwise(f"{r['namespace']}.{r['name']}")

    named = raw.select("*", _picked().alias("_row")).select("*", by_relation(named_if_fitting).alias("relation"))
    return named.select(
        *keep,
        route_topic(F.col("relation"), routes, prefix).alias("topic"),
        by_relation(lambda r: _known_json(F.col("_row"), r["columns"], True)).cast("binary").alias("key"),
        by_relation(lambda r: _known_json(F.col("_row"), r["columns"], False, unchanged)).cast("binary").alias("value"),
        headers.alias("headers"),
    )


# -- messages --------------------------------------------------------------------------------


def change_headers(
    host: str = "",
    port: int | str = "",
    database: str = "",
    ts_ms: int | None = None,
    with_op: bool = True,
) -> Column:
    """Headers of a change message. ``op`` is the one addition: values alone cannot tell a delete."""
    pairs = [
        ("version", F.lit(__version__)),
        ("lsn", lsn_text(F.col("lsn_start"))),
        ("ts_ms", (now_millis() if ts_ms is None else F.lit(ts_ms)).cast("string")),
        ("host", F.lit(host)),
        ("port", F.lit(str(port))),
        ("database", F.lit(database)),
        ("relation", F.col("relation")),
    ]
    if with_op:
        pairs.append(("op", F.col("op")))
    return payload.headers(pairs)


def change_messages(
    changes: DataFrame,
    headers: Column,
    routes: Routes = (),
    prefix: str = "",
    unchanged: str = "null",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Row changes as ``topic, key, value, headers``."""
    return changes.select(
        *keep,
        route_topic(F.col("relation"), routes, prefix).alias("topic"),
        key_json(F.col("cols")).cast("binary").alias("key"),
        tuple_json(F.col("cols"), unchanged).cast("binary").alias("value"),
        headers.alias("headers"),
    )
