"""Database tables as frames, read and written over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from relayframe.operators.catalog import primary_keys

# The two catalog views key lookup needs.
_CONSTRAINTS = (
    "SELECT constraint_schema, constraint_name, constraint_type, table_schema, table_name "
    "FROM information_schema.table_constraints"
)
_KEY_USAGE = "SELECT constraint_schema, constraint_name, column_name FROM information_schema.key_column_usage"


def table_options(
    url: str,
    table: str,
    condition: str = "",
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    login: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a table read, its condition evaluated by the database.

    With a partition column the read is split into ranges of it, one query per task; without one
    the whole table passes through a single connection.
    """
    options = {"url": url, "fetchsize": str(fetch_size)}
    query = f"SELECT * FROM {table} {condition}".strip()
    if partition_column is None:
        options["query"] = query
    else:
        if bounds is None or partitions is None:
            raise ValueError("a partitioned read needs bounds and a number of partitions")
        options |= {
            "dbtable": f"({query}) data",
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options | dict(login or {})


def read_table(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def bounds_query(table: str, column: str, condition: str = "") -> str:
    return f"SELECT min({column}) AS low, max({column}) AS high FROM {table} {condition}".strip()


def read_split_table(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    partitions: int,
    condition: str = "",
    login: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table read by many tasks, each a range of a numeric or time column the database indexes."""
    login = dict(login or {})
    row = read_table(spark, {"url": url, "query": bounds_query(table, column, condition), **login}).first()
    if row["low"] is None:
        return read_table(spark, table_options(url, table, condition, login=login))
    bounds = (row["low"], row["high"])
    return read_table(spark, table_options(url, table, condition, column, bounds, partitions, login=login))


def read_primary_keys(spark: SparkSession, url: str, login: Mapping[str, str] | None = None) -> DataFrame:
    """Key columns of every table of a database."""
    def catalog(query: str) -> DataFrame:
        return read_table(spark, {"url": url, "query": query, **(login or {})})

    return primary_keys(catalog(_CONSTRAINTS), catalog(_KEY_USAGE))


def append_rows(
    rows: DataFrame, url: str, table: str, batch_size: int = 10_000, login: Mapping[str, str] | None = None
) -> None:
    """Append rows to a table; the frame's columns are the insert's column list."""
    (
        rows.write.format("jdbc")
        .options(url=url, dbtable=table, batchsize=str(batch_size), **(login or {}))
        .mode("append")
        .save()
    )
