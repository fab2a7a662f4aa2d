"""Archives: gzip JSON lines under topic, time bucket, partition and offset chunk.

Own layout: ``topic=/bucket=/partition=/chunk={min}-{max}/n_rows=/digest=/*.json.gz``. All a manifest
needs is in the directory names, so listing replaces reading. The compatible layout
``{topic}/{bucket}/{partition}/{min}-{max}.gz`` is written and read as well.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relayframe.functions import times
from relayframe.operators import archive
from relayframe.operators.compaction import MERGE_LIMIT, label_chunks
from relayframe.schemas import ARCHIVE_ROW, MANIFEST, PREFIX
from relayframe.session import checkpointed, lookup_join, tasks_for

_LAYOUT = ["topic", "bucket", "partition", "chunk", "n_rows", "digest"]
# Typed here because inference would read buckets as times.
_LAYOUT_FIELDS = [
    T.StructField("topic", T.StringType()),
    T.StructField("bucket", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("chunk", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("digest", T.StringType()),
]
_FILE_FIELDS = [
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
]


def _store(labelled: DataFrame, root: str, replace: bool) -> None:
    writer = labelled.write.mode("append")
    if replace:
        writer = labelled.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (
        writer.option("compression", "gzip")
        .option("ignoreNullFields", "false")
        .partitionBy(*_LAYOUT)
        .json(root)
    )


def write_attempt(labelled: DataFrame, folder: str) -> None:
    """Store labelled rows in a folder of their own that no reader looks at yet.

    Tasks move their files into place themselves, as the folder counts as a whole later or not at all; a task that
    runs again writes the same names. So the driver moves nothing.
    """
    writer = labelled.write.mode("errorifexists").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.option("compression", "gzip").option("ignoreNullFields", "false").partitionBy(*_LAYOUT).json(folder)


def write_archive(
    rows: DataFrame,
    root: str,
    chunk_offsets: int = archive.CHUNK_OFFSETS,
    partitions: int | None = None,
    replace: bool = True,
) -> None:
    """Add archive rows to an archive, in one shuffle by chunk.

    Only directories of chunks with the very same records are replaced, so writing the same rows
    again changes nothing. The driver moves replaced directories one by one; ``replace=False`` appends
    instead, for a bulk load that is not repeated into the same place.
    """
    _store(archive.by_offset_range(rows, chunk_offsets, partitions), root, replace)


def _load(
    reader: DataFrameReader, root: str, topics: Sequence[str] | None, folders: Sequence[str] | None = None
) -> DataFrame:
    """Load an archive, listing only some folders of it, or the directories of the wanted topics if all exist."""
    if folders is not None:
        # Before the first write there is no base folder either.
        return reader.option("basePath", root).load(list(folders)) if folders else reader.load([])
    if topics:
        try:
            return reader.option("basePath", root).load([f"{root.rstrip('/')}/topic={t}" for t in topics])
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return reader.load(root)


def read_archive(
    spark: SparkSession,
    root: str,
    topics: Sequence[str] | None = None,
    since: str | datetime | None = None,
    until: str | datetime | None = None,
    with_timestamp: bool = False,
    folders: Sequence[str] | None = None,
) -> DataFrame:
    """Archive rows of some topics and buckets; other directories are not read. With ``folders``, as
    ``ArchiveLog.folders`` gives them, no other folder is even listed."""
    fields = list(ARCHIVE_ROW.fields)
    if with_timestamp:
        fields.append(T.StructField("timestamp", T.TimestampType()))
    reader = spark.read.schema(T.StructType(fields + _LAYOUT_FIELDS)).format("json")
    rows = _load(reader, root, topics, folders).drop("digest", "attempt")
    return archive.in_buckets(archive.of_topics(rows, topics), since, until)


def list_archive(
    spark: SparkSession,
    root: str,
    topics: Sequence[str] | None = None,
    since: str | datetime | None = None,
    until: str | datetime | None = None,
    folders: Sequence[str] | None = None,
) -> DataFrame:
    """Manifest of an archive, from its listing alone."""
    if folders is not None and not folders:
        return spark.createDataFrame([], MANIFEST)
    reader = spark.read.format("binaryFile").schema(T.StructType(_FILE_FIELDS + _LAYOUT_FIELDS))
    files = _load(reader, root, topics, folders)
    files = archive.in_buckets(archive.of_topics(files, topics), since, until)
    return files.select(
        *PREFIX,
        F.substring_index("chunk", "-", 1).cast("bigint").alias("min_offset"),
        F.substring_index("chunk", "-", -1).cast("bigint").alias("max_offset"),
        "n_rows",
        F.col("length").alias("size_bytes"),
        "path",
    )


def _in_bounds(path: Column, since, until) -> list[Column]:
    bucket = archive.path_bucket(path)
    conditions = []
    if since is not None:
        conditions.append(bucket >= times.bucket_bound(since))
    if until is not None:
        conditions.append(bucket <= times.bucket_bound(until))
    # A malformed path stays in, so that it fails the read instead of going unnoticed.
    return [(c | (bucket == "")) for c in conditions]


def _topic_roots(root: str, topics: Sequence[str]) -> list[str]:
    return [f"{root.rstrip('/')}/{topic}" for topic in topics]


def list_compatible(
    spark: SparkSession,
    root: str,
    topics: Sequence[str],
    since: str | datetime | None = None,
    until: str | datetime | None = None,
) -> DataFrame:
    """Chunks of a compatible-layout archive; row counts are not in its names, so they are null."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(_topic_roots(root, topics))
    # Spark encodes this path; ``path`` is as it stands, so a sign of percent in it says nothing.
    path = F.col("_metadata.file_path")
    for condition in _in_bounds(path, since, until):
        files = files.where(condition)
    return files.select(
        archive.parse_chunk_path(path).alias("chunk"), F.col("length").alias("size_bytes"), "path"
    ).select("chunk.*", F.lit(None).cast("bigint").alias("n_rows"), "size_bytes", "path")


def read_compatible(
    spark: SparkSession,
    root: str,
    topics: Sequence[str],
    since: str | datetime | None = None,
    until: str | datetime | None = None,
) -> DataFrame:
    """Archive rows of a compatible-layout archive. The bucket test is on file names, so files
    outside the bounds are left out when the scan is planned."""
    rows = (
        spark.read.schema(ARCHIVE_ROW).option("recursiveFileLookup", "true").json(_topic_roots(root, topics))
    )
    path = F.col("_metadata.file_path")
    for condition in _in_bounds(path, since, until):
        rows = rows.where(condition)
    return rows.select(archive.parse_chunk_path(path).alias("chunk"), *ARCHIVE_ROW.names).select(
        "chunk.topic", "chunk.bucket", "chunk.partition", *ARCHIVE_ROW.names
    )


def chunk_key(chunks: DataFrame) -> DataFrame:
    """The columns by which archive rows are joined to chunks of a manifest."""
    name = archive.chunk_name(F.col("min_offset"), F.col("max_offset"))
    return chunks.select(*PREFIX, name.alias("chunk")).distinct()


def rows_of_chunks(rows: DataFrame, chunks: DataFrame) -> DataFrame:
    """Rows of some chunks, given by :func:`chunk_key`. Where they are few, dynamic partition pruning
    keeps the other directories from being read; it asks for a filter on the joined side."""
    return lookup_join(rows, chunks.where(F.col("chunk") > ""), [*PREFIX, "chunk"], "left_semi")


def _met_chunks(spark: SparkSession, root: str, bounds: DataFrame) -> DataFrame | None:
    """Chunks of a compatible-layout archive whose offset range meets that of some rows of the same prefix."""
    topics = [row["topic"] for row in bounds.select("topic").distinct().collect()]
    found = []
    for topic in topics:
        try:
            listed = list_compatible(spark, root, [topic])
        except AnalysisException as error:
            # A topic that is new to the archive.
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found.append(listed)
    if not found:
        return None
    spans = bounds.groupBy(*PREFIX).agg(F.min("min_offset").alias("_low"), F.max("max_offset").alias("_high"))
    met = lookup_join(reduce(DataFrame.unionByName, found), checkpointed(spans), PREFIX, "inner")
    met = checkpointed(met.where("min_offset <= _high and max_offset >= _low").drop("_low", "_high"))
    return None if met.isEmpty() else met


def _move_chunks(spark: SparkSession, moves: Sequence[tuple[str, str]], staging: str) -> None:
    """Put files in their places, each at once and in the place of one that is there, and drop the folder they were in."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    overwrite = spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
    overwrite[0] = hadoop.Options.Rename.OVERWRITE

    def move(names: tuple[str, str]) -> None:
        source, target = (files.makeQualified(hadoop.Path(name)) for name in names)
        # Local files have checksums of Spark's beside them, which are no part of the layout.
        checksum = hadoop.Path(source.getParent(), f".{source.getName()}.crc")
        if source.toUri().getScheme() == "file":
            files.delete(checksum, False)
        files.rename(source, target, overwrite)

    for folder in {target.rpartition("/")[0] for _, target in moves}:
        files.mkdir(hadoop.Path(folder), hadoop.permission.FsPermission.getDirDefault(), True)
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(move, moves))
    files.delete(hadoop.Path(staging), True)


def write_compatible(
    rows: DataFrame,
    root: str,
    chunk_offsets: int = archive.CHUNK_OFFSETS,
    partitions: int | None = None,
) -> DataFrame:
    """Add archive rows to an archive of the compatible layout; gives the manifest of the chunks in their ranges,
    those that were there before as well.

    Only records that no stored chunk of their bucket holds are written, under their own bounds. So writing again
    changes nothing, and no file is replaced: both ends of a new chunk are new, so its name is. Executors may
    still know the files that they read. Spark names files itself, so it writes a file for each chunk to a folder
    that no reader looks at, and the driver then moves them, so that no reader meets half a chunk: a name for
    each chunk passes the driver, as it does in listing. Needs a store whose names may hold colons, and that
    every executor reaches.
    """
    spark, root = rows.sparkSession, root.rstrip("/")
    cut = rows.withColumn("_range", F.call_function("div", F.col("offset"), F.lit(chunk_offsets)))
    bounds = _bounds(cut)
    met, stored = _met_chunks(spark, root, bounds), spark.createDataFrame([], MANIFEST)
    if met is not None:
        # Offsets alone tell what is stored.
        chunk = archive.parse_chunk_path(F.col("_metadata.file_path"))
        offsets = spark.read.schema(ARCHIVE_ROW).json([row["path"] for row in met.select("path").collect()])
        offsets = offsets.select(chunk.alias("chunk"), "offset").select("chunk.*", "offset")
        offsets = checkpointed(offsets)
        name = [*PREFIX, "min_offset", "max_offset"]
        counts = checkpointed(offsets.groupBy(*name).agg(F.count(F.lit(1)).alias("n_rows")))
        stored = lookup_join(met.drop("n_rows"), counts, name).select(*MANIFEST.names)
        cut = cut.join(offsets.select(*PREFIX, "offset"), [*PREFIX, "offset"], "left_anti")
        bounds = _bounds(cut)
    n_rows = bounds.agg(F.sum("n_rows")).first()[0]
    if not n_rows:
        return stored
    name = archive.chunk_name(F.col("min_offset"), F.col("max_offset")).alias("chunk")
    columns = [*PREFIX, "chunk", *ARCHIVE_ROW.names]
    named = lookup_join(cut, bounds.select(*PREFIX, "_range", name), [*PREFIX, "_range"], "inner").select(*columns)
    whole = archive.once_in_order(named, [*PREFIX, "chunk"], F.lit(0), partitions or tasks_for(spark, n_rows))
    staging = f"{root}/_staging-{uuid.uuid4().hex}"
    writer = whole.write.option("compression", "gzip").option("ignoreNullFields", "false").option("maxRecordsPerFile", 0)
    writer.partitionBy(*PREFIX, "chunk").json(staging)
    counts = checkpointed(whole.groupBy(*PREFIX, "chunk").agg(F.count(F.lit(1)).alias("n_rows")))
    layout = T.StructType(_FILE_FIELDS + [f for f in _LAYOUT_FIELDS if f.name in (*PREFIX, "chunk")])
    listed = spark.read.format("binaryFile").schema(layout).load(staging).select(*PREFIX, "chunk", "length", "path")
    target = F.concat(F.lit(f"{root}/"), F.concat_ws("/", *PREFIX, "chunk"), F.lit(".gz"))
    written = checkpointed(lookup_join(listed, counts, [*PREFIX, "chunk"], "inner").withColumn("target", target))
    _move_chunks(spark, [tuple(row) for row in written.select("path", "target").collect()], staging)
    return stored.unionByName(
        written.select(
            *PREFIX,
            F.substring_index("chunk", "-", 1).cast("bigint").alias("min_offset"),
            F.substring_index("chunk", "-", -1).cast("bigint").alias("max_offset"),
            "n_rows",
            F.col("length").alias("size_bytes"),
            F.col("target").alias("path"),
        )
    )


def _bounds(cut: DataFrame) -> DataFrame:
    """Offset bounds and row count of each range of rows."""
    ends = [F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset"), F.count(F.lit(1)).alias("n_rows")]
    return checkpointed(cut.groupBy(*PREFIX, "_range").agg(*ends))


def disputed_rows(rows: DataFrame, manifest: DataFrame) -> DataFrame | None:
    """``topic, partition, bucket, offset`` of the rows that another chunk may hold as well; None for none.

    Told from the manifest: a chunk holds an offset once by the way it is written, so only offsets in the
    intersection with another chunk's range can repeat. Of chunks that meet at their ends, as the buckets of
    a log with late records do, these are few; other chunks are not read.
    """
    name = archive.chunk_name(F.col("min_offset"), F.col("max_offset")).alias("chunk")
    shared = archive.overlapping(manifest).select(*PREFIX, name, "shared_until", "shared_from")
    shared = checkpointed(shared)
    if shared.isEmpty():
        return None
    narrow = rows.select(*PREFIX, "chunk", "offset")
    # The filter lets dynamic partition pruning skip the other directories.
    met = lookup_join(narrow, shared.where(F.col("chunk") > ""), [*PREFIX, "chunk"], "inner")
    return met.where(archive.is_disputed()).select(*PREFIX, "offset")


def listed_tasks(spark: SparkSession, manifest: DataFrame) -> int:
    """Tasks for a shuffle of all rows that a manifest lists."""
    return tasks_for(spark, manifest.agg(F.sum("n_rows")).first()[0] or 0)


def repeated_records(
    narrow: DataFrame | None, keys: Sequence[str] = archive.RECORD, tasks: int | None = None
) -> DataFrame | None:
    """Records that occur more than once among the disputed rows; None for none."""
    if narrow is None:
        return None
    repeated = checkpointed(archive.repeated_offsets(narrow, keys, tasks))
    return None if repeated.isEmpty() else repeated


def current_root(spark: SparkSession, pointer: str, default: str) -> str:
    """Where readers of an archive find it: what ``pointer`` names last, or its first place."""
    try:
        named = spark.read.schema("version bigint, root string").parquet(pointer)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return default
    return named.agg(F.max_by("root", "version")).first()[0] or default


def move_pointer(spark: SparkSession, pointer: str, root: str) -> None:
    """Name a complete archive as the current one. One small file is added, so readers see either."""
    try:
        last = spark.read.schema("version bigint").parquet(pointer).agg(F.max("version")).first()[0] or 0
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        last = 0
    named = spark.range(1).select(F.lit(last + 1).cast("bigint").alias("version"), F.lit(root).alias("root"))
    named.write.mode("append").parquet(pointer)


def keeps_timestamps(spark: SparkSession, manifest: DataFrame) -> bool:
    """Whether an archive was written with timestamps, told by one chunk of each topic."""
    paths = [r["path"] for r in manifest.groupBy("topic").agg(F.min("path").alias("path")).collect()]
    if not paths:
        return False
    return not spark.read.schema("timestamp timestamp").json(paths).where("timestamp is not null").isEmpty()


def compact_archive(
    spark: SparkSession,
    source: str,
    target: str,
    topics: Sequence[str] | None = None,
    since: str | datetime | None = None,
    until: str | datetime | None = None,
    limit: int = MERGE_LIMIT,
    partitions: int | None = None,
) -> None:
    """Write an archive, or some topics and buckets of it, with its small chunks merged.

    The target must be a new location: the caller points readers at it once it is complete, so no
    reader meets both versions. Records in overlapping chunks are written once, and stale chunks
    are read too, so that no record depends on their being true copies. Timestamps stay if the archive
    keeps them; an archive that keeps some of them only is refused.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("compact into a new location")
    _store(merged_chunks(spark, source, topics, since, until, limit, partitions), target, replace=False)


def merged_chunks(
    spark: SparkSession,
    source: str,
    topics: Sequence[str] | None = None,
    since: str | datetime | None = None,
    until: str | datetime | None = None,
    limit: int = MERGE_LIMIT,
    partitions: int | None = None,
    folders: Sequence[str] | None = None,
) -> DataFrame:
    """Archive rows, each record of a bucket once, labelled with the merged chunks they belong to."""
    manifest = checkpointed(list_archive(spark, source, topics, since, until, folders))
    labels = label_chunks(manifest, limit)
    name = archive.chunk_name(F.col("min_offset"), F.col("max_offset")).alias("chunk")
    groups = checkpointed(labels.select(*PREFIX, name, "group_id"))
    rows = read_archive(spark, source, topics, since, until, True, folders).drop("n_rows")
    if not keeps_timestamps(spark, manifest):
        lost = F.raise_error(F.lit("some records of the archive keep a timestamp and others do not"))
        rows = rows.withColumn("offset", F.when(F.col("timestamp").isNull(), F.col("offset")).otherwise(lost))
        rows = rows.drop("timestamp")
    # A record that two buckets hold stays in both of them.
    keys = (*PREFIX, "offset")
    tasks = listed_tasks(spark, manifest)
    repeated = repeated_records(disputed_rows(rows, manifest), keys, tasks)
    grouped = lookup_join(rows, groups, [*PREFIX, "chunk"], "inner").drop("chunk")
    merged = archive.each_once(grouped, repeated, keys, tasks)
    return archive.in_chunks(merged, ["group_id"], partitions or tasks)
