"""Row shapes shared by every operator."""

from pyspark.sql import types as T

HEADERS = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])
)

# The columns a Kafka source yields with headers included, and a Kafka sink accepts.
LOG = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("headers", HEADERS),
    ]
)

TUPLE = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("data", T.BinaryType())])
)

# A row-change message as it arrives: column values only, described by a relation id.
RAW_CHANGES = T.StructType(
    [
        T.StructField("lsn_start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("op", T.StringType()),
        T.StructField("relation_id", T.LongType()),
        T.StructField("new_tuple", TUPLE),
        T.StructField("old_tuple", TUPLE),
    ]
)

RELATIONS = T.StructType(
    [
        T.StructField("relation_id", T.LongType()),
        T.StructField("namespace", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField(
            "columns",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("oid", T.IntegerType()),
                        T.StructField("is_key", T.BooleanType()),
                    ]
                )
            ),
        ),
    ]
)

# A log that holds relations between the changes: operation R, from its position on.
LOG_WITH_RELATIONS = T.StructType(
    [*RAW_CHANGES.fields, T.StructField("relation", T.StructType(RELATIONS.fields[1:]))]
)

# Relation versions, each from its position on.
RELATION_VERSIONS = T.StructType([*RELATIONS.fields, T.StructField("since", T.LongType())])

# A row change whose columns carry their own description.
CHANGES = T.StructType(
    [
        T.StructField("lsn_start", T.LongType()),
        T.StructField("lsn_end", T.LongType()),
        T.StructField("op", T.StringType()),
        T.StructField("relation_id", T.LongType()),
        T.StructField("relation", T.StringType()),
        T.StructField(
            "cols",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("oid", T.IntegerType()),
                        T.StructField("is_key", T.BooleanType()),
                        T.StructField("kind", T.StringType()),
                        T.StructField("data", T.BinaryType()),
                    ]
                )
            ),
        ),
    ]
)

ARCHIVE_ROW = T.StructType(
    [
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField(
            "headers",
            T.ArrayType(
                T.StructType(
                    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
                )
            ),
        ),
    ]
)

# Chunk identity; every chunk-level operator groups by these.
PREFIX = ("topic", "bucket", "partition")

MANIFEST = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("bucket", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("min_offset", T.LongType()),
        T.StructField("max_offset", T.LongType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("path", T.StringType()),
    ]
)

OFFSETS = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

RESTORE_OFFSETS = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("bucket", T.StringType()),
        T.StructField("offset", T.LongType()),
    ]
)
