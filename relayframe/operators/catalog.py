"""Lookups on database catalogs given as frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def primary_keys(table_constraints: DataFrame, key_column_usage: DataFrame) -> DataFrame:
    """Key columns of every table: ``table_schema, table_name, column_name``.

    Joins on the constraint's schema and name, since names repeat across schemas.
    """
    keys = table_constraints.where(F.col("constraint_type") == "PRIMARY KEY").select(
        "constraint_schema", "constraint_name", "table_schema", "table_name"
    )
    usage = key_column_usage.select("constraint_schema", "constraint_name", "column_name")
    return keys.join(usage, ["constraint_schema", "constraint_name"]).select(
        "table_schema", "table_name", "column_name"
    )


def key_columns_of(primary_key_columns: DataFrame, schema: str, table: str) -> list[str]:
    """Key column names of one table, for building its messages."""
    found = primary_key_columns.where((F.col("table_schema") == schema) & (F.col("table_name") == table))
    return [row["column_name"] for row in found.select("column_name").collect()]


def insertable_columns(columns: DataFrame) -> DataFrame:
    """Catalog rows of the columns a writer has to supply: those without a default."""
    return columns.where(F.coalesce(F.col("default_expression"), F.lit("")) == "")


def target_schema(columns: DataFrame, table: str) -> T.StructType:
    """StructType of one target table from ``table, name, type, nullable, default_expression`` rows.

    One row per column of a single table comes to the driver.
    """
    rows = insertable_columns(columns.where(F.col("table") == table)).collect()
    if not rows:
        raise ValueError(f"the target lists no columns of {table}")
    return T.StructType(
        [T.StructField(r["name"], T.DataType.fromDDL(r["type"]), r["nullable"]) for r in rows]
    )
