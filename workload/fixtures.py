"""Inputs of the queries, derived from the given tables by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relayframe import __version__
from relayframe.functions import codecs, payload
from relayframe.operators.changes import OID
from relayframe.schemas import LOG_WITH_RELATIONS, RAW_CHANGES, RELATIONS
from relayframe.session import checkpointed

TS_MS = 1_700_000_000_000
WEEK = 7 * 24 * 3600


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_log(events: DataFrame) -> DataFrame:
    """Events as log records. The event id is the offset: unique and rising, with gaps in a
    partition as in a compacted topic, and known without numbering rows."""
    ts = F.date_trunc("millisecond", F.col("ts").cast("timestamp"))
    typed = events.select(
        "event_id", "event_type", "user_id", "props", F.unix_millis(ts).alias("ts"), ts.alias("timestamp")
    )
    return typed.select(
        F.concat(F.lit("events."), F.col("event_type")).alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        "timestamp",
        payload.object_json(["event_id"]).cast("binary").alias("key"),
        payload.object_json(["event_id", "event_type", "props", "ts", "user_id"]).cast("binary").alias("value"),
        payload.headers([("version", F.lit(__version__)), ("relation", F.lit("public.events"))]).alias("headers"),
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(read(spark, sf_dir, "events"))


def marks(records: DataFrame) -> DataFrame:
    """Marks half way through each partition; partition 3 has never been seen."""
    half = F.call_function("div", F.max("offset"), F.lit(2)).alias("offset")
    return checkpointed(records.where(F.col("partition") != 3).groupBy("topic", "partition").agg(half))


def restore_marks(rows: DataFrame) -> DataFrame:
    half = F.call_function("div", F.min("offset") + F.max("offset"), F.lit(2)).alias("offset")
    return checkpointed(rows.where(F.col("partition") != 3).groupBy("topic", "partition", "bucket").agg(half))


ORDER_COLUMNS = [
    ("o_orderkey", "int8", True),
    ("o_custkey", "int8", False),
    ("o_orderstatus", "varchar", False),
    ("o_totalprice", "numeric", False),
    ("o_orderdate", "timestamp", False),
    ("o_orderpriority", "text", False),
]
HEARTBEAT_ID = 3


def relations(spark: SparkSession) -> DataFrame:
    columns = [(name, OID[kind], key) for name, kind, key in ORDER_COLUMNS]
    rows = [(i, "public", f"orders_{i}", columns) for i in range(3)]
    rows.append((HEARTBEAT_ID, "public", "pipe_health", columns))
    return spark.createDataFrame(rows, RELATIONS)


def raw_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a row-change log: one message per order."""
    orders = read(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    texts = {
        "o_totalprice": F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
        "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
    }
    op = F.when(key % 10 == 7, "D").when(key % 10 == 8, "U").when(key % 10 == 9, "O").otherwise("I")

    def cell(kind: Column, text: Column) -> Column:
        return F.struct(kind.alias("kind"), text.cast("binary").alias("data"))

    def new_cell(name: str) -> Column:
        text = texts.get(name, F.col(name).cast("string"))
        if name != "o_orderpriority":
            return cell(F.lit("t"), text)
        # An update does not resend this column.
        resent = F.col("op") != "U"
        return cell(F.when(resent, "t").otherwise("u"), F.when(resent, text))

    def old_cell(name: str, is_key: bool) -> Column:
        return cell(F.lit("t"), F.col(name).cast("string")) if is_key else cell(F.lit("n"), F.lit(None))

    return orders.withColumn("op", op).select(
        (key * 10).alias("lsn_start"),
        F.lit(8).cast("bigint").alias("length"),
        "op",
        F.when(key % 50 == 0, F.lit(HEARTBEAT_ID)).otherwise(key % 3).cast("bigint").alias("relation_id"),
        F.when(F.col("op").isin("I", "U"), F.array(*[new_cell(n) for n, _, _ in ORDER_COLUMNS])).alias("new_tuple"),
        F.when(F.col("op") == "D", F.array(*[old_cell(n, k) for n, _, k in ORDER_COLUMNS])).alias("old_tuple"),
    )


BINARY_COLUMNS = [
    ("o_orderkey", "int8", True),
    ("big", "bool", False),
    ("day", "date", False),
    ("id", "uuid", False),
    ("price", "numeric", False),
    ("priority", "text", False),
    ("zoned", "timestamptz", False),
]


def binary_changes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as inserts; cells of even keys are in binary format, of odd keys in text format."""
    orders = read(spark, sf_dir, "orders")
    key, cents = F.col("o_orderkey"), F.round(F.col("o_totalprice") * 100).cast("bigint")
    when = F.date_trunc("day", F.col("o_orderdate").cast("timestamp"))
    days = F.datediff(when, F.lit("2000-01-01"))

    def number(value: Column, size: int) -> Column:
        return F.unhex(F.right(F.lpad(F.hex(value.cast("bigint")), 16, "0"), F.lit(size * 2)))

    def div(value: Column, by: int) -> Column:
        return F.call_function("div", value, F.lit(by).cast("bigint"))

    digest = F.md5(key.cast("string"))
    # Digits by ten thousands: two before the point and one after it, of which the scale shows two.
    price = F.concat(
        *[number(F.lit(n), 2) for n in (3, 1, 0, 2)],
        number(div(cents, 1_000_000), 2),
        number(div(cents, 100) % 10_000, 2),
        number(cents % 100 * 100, 2),
    )
    cells = {
        "o_orderkey": (key.cast("string"), number(key, 8)),
        "big": (F.when(cents > 20_000_000, "t").otherwise("f"), number((cents > 20_000_000).cast("int"), 1)),
        "day": (F.date_format(when, "yyyy-MM-dd"), number(days, 4)),
        "id": (codecs.uuid_text(F.unhex(digest)), F.unhex(digest)),
        "price": (F.col("o_totalprice").cast("decimal(18,2)").cast("string"), price),
        "priority": (F.col("o_orderpriority"), F.col("o_orderpriority").cast("binary")),
        "zoned": (
            F.concat(F.date_format(when, "yyyy-MM-dd HH:mm:ss"), F.lit("+00")),
            number(days.cast("bigint") * 86_400_000_000, 8),
        ),
    }
    even = key % 2 == 0
    row = F.array(
        *[
            F.struct(
                F.when(even, "b").otherwise("t").alias("kind"),
                F.when(even, as_bytes).otherwise(as_text.cast("binary")).alias("data"),
            )
            for as_text, as_bytes in (cells[n] for n, _, _ in BINARY_COLUMNS)
        ]
    )
    raw = orders.select(
        (key * 10).alias("lsn_start"),
        F.lit(8).cast("bigint").alias("length"),
        F.lit("I").alias("op"),
        (key % 3).cast("bigint").alias("relation_id"),
        row.alias("new_tuple"),
        F.lit(None).cast(row_type()).alias("old_tuple"),
    )
    columns = [(name, OID[kind], is_key) for name, kind, is_key in BINARY_COLUMNS]
    return raw, spark.createDataFrame([(i, "public", f"orders_{i}", columns) for i in range(3)], RELATIONS)


def row_type() -> T.DataType:
    return RAW_CHANGES["new_tuple"].dataType


def wide_relations(spark: SparkSession) -> DataFrame:
    """Further relations, of more columns than a query spells out."""
    columns = [(f"c{i}", OID["text"], i == 0) for i in range(250)]
    return spark.createDataFrame([(100 + i, "public", f"wide_{i}", columns) for i in range(20)], RELATIONS)


# Positions from which the altered table has other columns.
ALTERED = (20_000, 60_000)


def altered_changes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Changes of one table that has no priority between the two positions."""
    raw, _ = binary_changes(spark, sf_dir)
    at = [n for n, _, _ in BINARY_COLUMNS].index("priority")
    dropped = F.col("lsn_start").between(ALTERED[0], ALTERED[1] - 1)
    cells = F.filter("new_tuple", lambda c, i: ~dropped | (i != at))
    raw = raw.withColumns({"new_tuple": cells, "relation_id": F.lit(7).cast("bigint")})
    columns = [(name, OID[kind], is_key) for name, kind, is_key in BINARY_COLUMNS]
    less = [c for c in columns if c[0] != "priority"]
    versions = [(columns, None), (less, ALTERED[0]), (columns, ALTERED[1])]
    rows = [(7, "public", "orders", c, since) for c, since in versions]
    return raw, spark.createDataFrame(rows, T.StructType([*RELATIONS.fields, T.StructField("since", T.LongType())]))


def log_with_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The altered table's log with its relations in it, each before the changes that it describes."""
    raw, versions = altered_changes(spark, sf_dir)
    sent = versions.select(
        F.coalesce("since", F.lit(0)).cast("bigint").alias("lsn_start"),
        F.lit(0).cast("bigint").alias("length"),
        F.lit("R").alias("op"),
        "relation_id",
        F.struct("namespace", "name", "columns").alias("relation"),
    )
    return raw.unionByName(sent, allowMissingColumns=True).select(*LOG_WITH_RELATIONS.fieldNames())


def with_ends(rows: DataFrame, inner: Column) -> DataFrame:
    """Archive rows for which ``inner`` holds, and the first and last row of every bucket and partition."""
    keys = ["topic", "bucket", "partition"]
    ends = rows.groupBy(*keys).agg(F.min("offset").alias("_low"), F.max("offset").alias("_high"))
    return rows.join(ends, keys).where(inner | F.col("offset").isin(F.col("_low"), F.col("_high"))).drop("_low", "_high")


def catalog(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Catalog frames with a constraint per customer, its name present in two schemas."""
    customers = read(spark, sf_dir, "customer")
    named = customers.select(
        "c_custkey",
        F.concat(F.lit("pk_"), F.col("c_custkey")).alias("constraint_name"),
        F.explode(F.array(F.lit("sales"), F.lit("audit"))).alias("constraint_schema"),
    )
    constraints = named.select(
        "constraint_schema",
        "constraint_name",
        F.when(F.col("c_custkey") % 7 == 0, "FOREIGN KEY").otherwise("PRIMARY KEY").alias("constraint_type"),
        F.col("constraint_schema").alias("table_schema"),
        F.concat(F.lit("t_"), F.col("c_custkey")).alias("table_name"),
    )
    columns = F.when(F.col("constraint_schema") == "sales", F.array(F.lit("id"))).otherwise(
        F.array(F.lit("id"), F.lit("version"))
    )
    usage = named.select("constraint_schema", "constraint_name", F.explode(columns).alias("column_name"))
    return constraints, usage


TARGET_COLUMNS = "table string, name string, type string, nullable boolean, default_expression string"


def target_columns(spark: SparkSession) -> DataFrame:
    """Catalog of the target table: two columns no message has, and one with a default."""
    rows = [
        ("events", "event_id", "bigint", False, ""),
        ("events", "user_id", "bigint", False, ""),
        ("events", "event_type", "string", True, ""),
        ("events", "ts", "timestamp", False, ""),
        ("events", "missing_int", "int", False, ""),
        ("events", "missing_text", "string", False, ""),
        ("events", "missing_note", "string", True, ""),
        ("events", "loaded_at", "timestamp", False, "now()"),
    ]
    return spark.createDataFrame(rows, TARGET_COLUMNS)


EVENT_TARGET = T.StructType(
    [
        T.StructField("event_id", T.LongType(), False),
        T.StructField("user_id", T.LongType(), False),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("ts", T.TimestampType(), False),
    ]
)

# Offsets per chunk of the manifest below: about three records of a partition.
MANIFEST_CHUNK = 60
RECORD_BYTES = 1_200_000


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small chunks of the log in weekly buckets, with made-up sizes."""
    from relayframe.operators.archive import chunk_stats

    stats = chunk_stats(log(spark, sf_dir), WEEK, MANIFEST_CHUNK)
    return stats.withColumn("size_bytes", F.col("n_rows") * RECORD_BYTES)
