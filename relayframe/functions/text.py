"""Name and pattern helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def qualify(namespace: Column, name: Column) -> Column:
    return F.concat_ws(".", namespace, name)


def split_qualified(table: Column) -> Column:
    """``schema.table`` as a struct; only the first dot splits, and a missing dot fails the query."""
    dot = F.locate(".", table)
    checked = F.when(dot > 0, table).otherwise(
        F.raise_error(F.concat(F.lit("table without a schema: "), table, F.lit(" (write schema.table)")))
    )
    return F.struct(
        F.substring_index(checked, ".", 1).alias("schema"),
        F.substring(checked, dot + 1, F.length(table)).alias("table"),
    )


def split_table_name(table: str) -> tuple[str, str]:
    """Driver-side form of :func:`split_qualified` for names given as arguments."""
    schema, dot, name = table.partition(".")
    if not dot:
        raise ValueError(f"table without a schema: {table} (write schema.table)")
    return schema, name


def ends_with_any(col: Column, suffixes) -> Column:
    found = F.lit(False)
    for suffix in suffixes:
        found = found | col.endswith(suffix)
    return found
