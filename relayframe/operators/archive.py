"""Log records as archive rows, grouped in time buckets and offset chunks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relayframe.functions import times
from relayframe.schemas import HEADERS, PREFIX
from relayframe.session import checkpointed, is_small, lookup_join, tasks_for

# What tells a record from every other one of a log.
RECORD = ("topic", "partition", "offset")

# Offsets one chunk may span. Offsets are unique in a partition, so this bounds a chunk's rows too.
CHUNK_OFFSETS = 250_000
# Ranges of few rows are joined up to this part of the rows that a chunk may have, so that tasks stay even.
MERGED_PART = 8
# Offsets one tile of chunk metadata spans, which bounds the chunks a task sorts together.
TILE_OFFSETS = 1 << 20

# Chunk file layout.
CHUNK_PATH = r"^(.+)/(\d\d\d\d-\d\d-\d\d \d\d:\d\d:\d\d)/(\d+)/(\d+)-(\d+)\.gz$"
OFFSET_FORMAT = "%018d"


def chunk_name(min_offset: Column, max_offset: Column) -> Column:
    """Zero-padded bounds, so that names sort like offsets."""
    return F.concat(F.format_string(OFFSET_FORMAT, min_offset), F.lit("-"), F.format_string(OFFSET_FORMAT, max_offset))


def parse_chunk_path(path: Column) -> Column:
    """Topic, bucket, partition and offset bounds of a chunk path; a malformed path fails the query."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    checked = F.when(decoded.rlike(CHUNK_PATH), decoded).otherwise(
        F.raise_error(F.concat(F.lit("invalid chunk path: "), path))
    )

    def part(i: int) -> Column:
        return F.regexp_extract(checked, CHUNK_PATH, i)

    return F.struct(
        F.substring_index(part(1), "/", -1).alias("topic"),
        part(2).alias("bucket"),
        part(3).cast("int").alias("partition"),
        part(4).cast("bigint").alias("min_offset"),
        part(5).cast("bigint").alias("max_offset"),
    )


def path_bucket(path: Column) -> Column:
    """Bucket of a chunk path, empty if malformed; depends on the path alone, so it prunes files."""
    return F.regexp_extract(F.url_decode(path), CHUNK_PATH, 2)


def _text(col: Column, binary: str, keep_nulls: bool) -> Column:
    text = F.base64(col) if binary == "base64" else col.cast("string")
    return text if keep_nulls else F.coalesce(text, F.lit(""))


def to_archive_rows(
    log: DataFrame,
    interval: str | int | timedelta = "1h",
    binary: str = "text",
    keep_nulls: bool = False,
    keep_timestamp: bool = False,
) -> DataFrame:
    """Records as archive rows under ``topic, bucket, partition``.

    The defaults give the compatible four fields, in which null and empty are both ``""`` and bytes
    are text. ``binary="base64"``, ``keep_nulls`` and ``keep_timestamp`` keep what those lose.
    """
    return log.select(
        "topic",
        times.bucket(F.col("timestamp"), interval).alias("bucket"),
        "partition",
        "offset",
        _text(F.col("key"), binary, keep_nulls).alias("key"),
        _text(F.col("value"), binary, keep_nulls).alias("value"),
        F.transform(
            F.coalesce(F.col("headers"), F.array().cast(HEADERS)),
            lambda h: F.struct(h["key"].alias("key"), _text(h["value"], binary, keep_nulls).alias("value")),
        ).alias("headers"),
        *(["timestamp"] if keep_timestamp else []),
    )


def from_archive_rows(rows: DataFrame, binary: str = "text") -> DataFrame:
    """Archive rows as log records. Without a kept timestamp they get a new one when produced."""

    def raw(col: Column) -> Column:
        return F.unbase64(col) if binary == "base64" else col.cast("binary")

    timestamp = F.col("timestamp") if "timestamp" in rows.columns else F.lit(None).cast("timestamp")
    return rows.select(
        "topic",
        "partition",
        "offset",
        timestamp.alias("timestamp"),
        raw(F.col("key")).alias("key"),
        raw(F.col("value")).alias("value"),
        F.transform(
            "headers", lambda h: F.struct(h["key"].alias("key"), raw(h["value"]).alias("value"))
        ).alias("headers"),
    )


def chunk_stats(
    log: DataFrame, interval: str | int | timedelta = "1h", chunk_offsets: int | None = None
) -> DataFrame:
    """Offset bounds and row count per topic, bucket and partition, or per offset chunk of those."""
    keys = [F.col("topic"), times.bucket(F.col("timestamp"), interval).alias("bucket"), F.col("partition")]
    if chunk_offsets:
        keys.append(F.call_function("div", F.col("offset"), F.lit(chunk_offsets)).alias("chunk_no"))
    stats = log.groupBy(*keys).agg(
        F.min("offset").alias("min_offset"),
        F.max("offset").alias("max_offset"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    return stats.drop("chunk_no")


def once_in_order(rows: DataFrame, keys: Sequence[str], first: Column, partitions: int | None = None) -> DataFrame:
    """Bring rows of equal keys together, in offset order, by one shuffle and one sort. Of the rows of an offset the
    one that is least by ``first`` stays.

    A window holds the copies of one record only, so no task keeps a chunk besides what it sorts.
    """
    tasks = partitions or tasks_for(rows.sparkSession, rows.count())
    copy = F.row_number().over(Window.partitionBy(*keys, "offset").orderBy(first))
    return rows.repartition(tasks, *keys).withColumn("_copy", copy).where("_copy = 1").drop("_copy")


def in_chunks(rows: DataFrame, by: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Bring each chunk's rows together in offset order and label them with what the chunk holds.

    ``by`` names what, next to topic, bucket and partition, tells chunks apart. It has to bound a
    chunk's size: that is what spreads a hot bucket over tasks. One shuffle and one sort serve both
    the removal of repeats and the labels: offset bounds, row count, and a digest of the offsets,
    so that only chunks of the same records share a name.

    The number of tasks is fixed, as compressing and opening files outweigh the bytes by which AQE
    would merge tasks. Without ``partitions`` it follows the rows, which are counted for that.
    """
    keys = [*PREFIX, *by]
    chunk = Window.partitionBy(*keys)
    tasks = partitions or tasks_for(rows.sparkSession, rows.count())
    before = F.lag("offset").over(chunk.orderBy("offset"))
    labelled = (
        rows.repartition(tasks, *keys)
        .withColumn("_before", before)
        .where(F.col("_before").isNull() | (F.col("_before") < F.col("offset")))
        .drop("_before")
        .withColumn("chunk", chunk_name(F.min("offset").over(chunk), F.max("offset").over(chunk)))
        .withColumn("n_rows", F.count(F.lit(1)).over(chunk))
        .withColumn("digest", F.hex(F.bit_xor(F.xxhash64("offset")).over(chunk)))
    )
    return labelled.drop(*by).sortWithinPartitions(*PREFIX, "chunk", "n_rows", "digest", "offset")


def by_offset_range(rows: DataFrame, chunk_offsets: int = CHUNK_OFFSETS, partitions: int | None = None) -> DataFrame:
    """Archive rows labelled with chunks of a bounded offset range.

    A prefix whose offsets are sparse would get a small file for each range. So without ``partitions`` rows are
    counted by range, and neighbouring ranges, as many as a power of two, make one chunk of
    ``chunk_offsets / MERGED_PART`` rows at most. The same rows make the same chunks.
    """
    cut = rows.withColumn("_range", F.call_function("div", F.col("offset"), F.lit(chunk_offsets)))
    if partitions:
        return in_chunks(cut, ["_range"], partitions)
    counts = cut.groupBy(*PREFIX, "_range").agg(F.count(F.lit(1)).alias("n"))
    prefixes = checkpointed(counts.groupBy(*PREFIX).agg(F.max("n").alias("most"), F.sum("n").alias("n")))
    tasks = tasks_for(rows.sparkSession, prefixes.agg(F.sum("n")).first()[0] or 0)
    room = F.greatest(F.lit(chunk_offsets / MERGED_PART) / F.col("most"), F.lit(1.0))
    joined = prefixes.select(*PREFIX, F.pow(F.lit(2.0), F.floor(F.log2(room))).cast("bigint").alias("_joined")).where("_joined > 1")
    merged = F.call_function("div", F.col("_range"), F.coalesce("_joined", F.lit(1).cast("bigint")))
    cut = lookup_join(cut, joined, PREFIX).withColumn("_range", merged).drop("_joined").select(*cut.columns)
    return in_chunks(cut, ["_range"], tasks)


def without_repeats(rows: DataFrame, keys: Sequence[str] = RECORD) -> DataFrame:
    """One copy of each record. The key holds the offset, so no key is hot."""
    return rows.dropDuplicates(list(keys))


def in_buckets(rows: DataFrame, since: str | datetime | None = None, until: str | datetime | None = None) -> DataFrame:
    """Rows whose bucket starts within the bounds, both included."""
    if since is not None:
        rows = rows.where(F.col("bucket") >= times.bucket_bound(since))
    if until is not None:
        rows = rows.where(F.col("bucket") <= times.bucket_bound(until))
    return rows


def of_topics(rows: DataFrame, topics: Sequence[str] | None) -> DataFrame:
    return rows.where(F.col("topic").isin(*topics)) if topics else rows


def tile_of(tile_offsets: int) -> Column:
    return F.call_function("div", F.col("min_offset"), F.lit(tile_offsets))


def with_previous_chunk(chunks: DataFrame, tile_offsets: int = TILE_OFFSETS) -> DataFrame:
    """Add the bounds of the chunk before each one in its prefix (null for the first).

    Sorts within tiles of a fixed offset span; only each tile's last chunk meets the other tiles,
    so a prefix with very many chunks is not sorted in one task.
    """
    bounds = F.struct("min_offset", "max_offset")
    tiled = chunks.withColumn("_tile", tile_of(tile_offsets))
    keys = [*PREFIX, "_tile"]
    last = tiled.groupBy(*keys).agg(F.max(bounds).alias("_last"))
    prior = last.select(
        *keys, F.lag("_last").over(Window.partitionBy(*PREFIX).orderBy("_tile")).alias("_prior")
    )
    within = F.lag(bounds).over(Window.partitionBy(*keys).orderBy("min_offset", "max_offset"))
    previous = F.coalesce(F.col("_within"), F.col("_prior"))
    return (
        tiled.withColumn("_within", within)
        .join(prior, keys, "left")
        .select(
            *chunks.columns,
            previous["min_offset"].alias("prev_min_offset"),
            previous["max_offset"].alias("prev_max_offset"),
        )
    )


def overlapping(chunks: DataFrame, tile_offsets: int = TILE_OFFSETS) -> DataFrame:
    """Chunks whose offset range meets another chunk's of the same topic partition, in any bucket,
    each named once by prefix and bounds. Only these can hold a record twice, and of their offsets only those
    up to ``shared_until``, the last end of a chunk that starts before, and from ``shared_from`` on, the first
    start behind theirs; both are null where no such chunk reaches in.

    Copies of a chunk are counted before anything is sorted. Each tile of a fixed offset span is
    sorted on its own; of the others it learns the highest end before and the first start after it.
    """
    keys = ["topic", "partition", "_tile"]
    bounds = ["min_offset", "max_offset"]
    across = Window.partitionBy("topic", "partition").orderBy("_tile")
    within = Window.partitionBy(*keys).orderBy(*bounds)
    earlier = (Window.unboundedPreceding, -1)
    tiled = (
        chunks.groupBy(*PREFIX, *bounds)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_tile", tile_of(tile_offsets))
    )
    edges = tiled.groupBy(*keys).agg(F.min("min_offset").alias("_first"), F.max("max_offset").alias("_top"))
    edges = edges.select(
        *keys,
        F.max("_top").over(across.rowsBetween(*earlier)).alias("_top_before"),
        F.lead("_first").over(across).alias("_first_after"),
    )
    before = F.greatest("_seen", "_top_before")
    after = F.coalesce("_next", "_first_after")
    shared_until = F.when(F.col("_copies") > 1, F.col("max_offset")).when(before >= F.col("min_offset"), before)
    shared_from = F.when(after <= F.col("max_offset"), after)
    return (
        tiled.withColumn("_seen", F.max("max_offset").over(within.rowsBetween(*earlier)))
        .withColumn("_next", F.lead("min_offset").over(within))
        .join(edges, keys)
        .select(*PREFIX, *bounds, shared_until.alias("shared_until"), shared_from.alias("shared_from"))
        .where("shared_until IS NOT NULL OR shared_from IS NOT NULL")
    )


def is_disputed() -> Column:
    """Whether another chunk may hold the offset as well, by the columns of :func:`overlapping`."""
    until, since = F.col("offset") <= F.col("shared_until"), F.col("offset") >= F.col("shared_from")
    return F.coalesce(until, F.lit(False)) | F.coalesce(since, F.lit(False))


def repeated_offsets(narrow: DataFrame, keys: Sequence[str] = RECORD, tasks: int | None = None) -> DataFrame:
    """The keys of records that occur more than once, and how often (``n``). Only these columns are
    shuffled, to ``tasks`` if given, and else counted in each task before."""
    if tasks is not None:
        narrow = narrow.repartition(tasks, *keys)
    return narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def each_once(
    rows: DataFrame, repeated: DataFrame | None, keys: Sequence[str] = RECORD, tasks: int | None = None
) -> DataFrame:
    """Every record of the rows once, given the repeated ones, one row each.

    If those are few, others stay where they are. If they are many, all rows are read and shuffled once, to
    ``tasks`` if given, rather than once for those that repeat and once for the others.
    """
    if repeated is None:
        return rows
    known = repeated.select(*keys)
    if is_small(known):
        several = rows.join(F.broadcast(known), list(keys), "left_semi")
        return rows.join(F.broadcast(known), list(keys), "left_anti").unionByName(without_repeats(several, keys))
    copy = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
    dealt = rows if tasks is None else rows.repartition(tasks, *keys)
    return dealt.withColumn("_copy", copy).where("_copy = 1").drop("_copy")
