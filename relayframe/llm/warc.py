"""WARC archives: writing pages, and reading records back through their chain of boundaries.

A file is read in pieces between occurrences of the version line that starts a record. Every occurrence
is a candidate record, and its header says where the record after it would start. Only the record at
offset 0 is certain; pointer jumping doubles the reach of every candidate's successor from round to
round and keeps the candidates that the chain from the file's start reaches. A version line inside a
payload is never reached, so its piece is put back into the record it lies in.

Nothing but offsets takes part in the rounds; payloads, numbered once and kept in shared storage, meet
their offsets once.

Defined results: a null payload is written as the empty one; a null url as an empty one, and control
characters in urls, which would break the header, are left out; a null id as an empty one. Of pages
with equal payloads of at least ``min_bytes`` bytes those with the smallest id are responses, the others
revisits of that id (a null id never is the smallest unless all are null). Repeated rows are written as
often as they occur. Other columns are not written. An empty table gives an archive without records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relayframe.session import checkpointed, lookup_join, scratch_path

# The record format of WARC 1.1.
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_REVISIT_BYTES = 100
RECORDS_PER_FILE = 50_000
ID_PREFIX = "urn:x-page:"


def write_pages(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date: str = "2024-01-01T00:00:00Z",
    min_bytes: int = MIN_REVISIT_BYTES,
) -> None:
    """Writes one record per page as compressed files under ``path``."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.regexp_replace(F.coalesce(F.col(url_col), F.lit("")), r"[\x00-\x1F\x7F]", "").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).alias("n_bytes"),
        F.sha2(payload, 256).alias("digest"),
    )
    repeated = (
        rows.where(F.col("n_bytes") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first", F.lit(True).alias("is_repeated"))
    )
    rows = lookup_join(rows, checkpointed(repeated), ["digest"])
    revisit = F.coalesce(F.col("is_repeated") & ~F.col("id").eqNullSafe(F.col("first")), F.lit(False))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("n_bytes").cast("string"),
        F.lit(END),
    )
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n_bytes"))
    record = F.concat(
        F.lit(f"{MAGIC}WARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"\r\nWARC-Record-ID: <{ID_PREFIX}"),
        F.coalesce(F.col("id").cast("string"), F.lit("")),
        F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "),
        F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha256:"),
        F.col("digest"),
        F.when(
            revisit,
            F.concat(
                F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: <{ID_PREFIX}"),
                F.coalesce(F.col("first").cast("string"), F.lit("")),
                F.lit(">"),
            ),
        ).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        length.cast("string"),
        F.lit(END),
        http,
        F.when(revisit, "").otherwise(F.col("payload")),
    )
    (
        rows.select(record.alias("value"))
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


def _field(header: Column, name: str) -> Column:
    return F.regexp_extract(header, rf"(?im)^{name}:[ \t]*(.*?)[ \t]*\r?$", 1)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of every file between version lines, with their place: ``file, block, at``.

    They are numbered once and kept in shared storage: how a scan packs files, and with that the numbers,
    may change from one scan to the next.
    """
    read = spark.read.option("lineSep", MAGIC).text(path)
    kept = scratch_path(spark, "warc-pieces")
    read.select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    ).write.option("compression", "zstd").parquet(kept)
    return spark.read.schema("file long, block long, at long, value string").parquet(kept)


def candidates(pieces: DataFrame) -> DataFrame:
    """``file, at, offset, end, successor`` of every piece; the piece before the first version line has a
    negative offset. ``successor`` is null where no header with a length follows."""
    header = F.substring_index("value", END, 1)
    length = _field(header, "Content-Length").try_cast("long")
    narrow = pieces.select(
        "file",
        "block",
        "at",
        F.octet_length("value").cast("long").alias("n_bytes"),
        F.when(F.contains(F.col("value"), F.lit(END)), F.octet_length(header) + length).alias("n_record"),
    )
    before = Window.partitionBy("file").orderBy("block", "at").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.coalesce(F.sum(F.col("n_bytes") + len(MAGIC)).over(before), F.lit(0))
    placed = narrow.withColumn("offset", passed - len(MAGIC))
    return placed.select(
        "file",
        "at",
        "offset",
        (F.col("offset") + len(MAGIC) + F.col("n_bytes")).alias("end"),
        (F.col("offset") + len(MAGIC) + F.col("n_record") + 2 * len(END)).alias("successor"),
    )


def _runs(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``head``, the first offset of the run that each is in: candidates that follow each
    other by their successors, entered only at the head."""
    in_file = Window.partitionBy("file").orderBy("offset")
    nodes = checkpointed(nodes.withColumn("following", F.lead("offset").over(in_file)))
    leaps = nodes.where("successor > offset and not successor <=> following")
    targets = leaps.select("file", F.col("successor").alias("offset"), F.lit(True).alias("is_target")).distinct()
    nodes = nodes.join(targets, ["file", "offset"], "left")
    goes_on = F.lag(F.col("successor").eqNullSafe(F.col("following"))).over(in_file)
    is_head = F.coalesce("is_target", F.lit(False)) | ~F.coalesce(goes_on, F.lit(False))
    nodes = nodes.withColumn("start", F.when(is_head, F.col("offset")))
    head = F.last("start", ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, 0))
    return checkpointed(nodes.withColumn("head", head).select("file", "offset", "successor", "head"))


def reachable(nodes: DataFrame) -> DataFrame:
    """``file, offset`` of the candidates that the chain of successors from offset 0 reaches.

    Runs of candidates in the order of the file count as one node, which leaves the rounds only what
    false candidates break up.
    """
    members = _runs(nodes.where("offset >= 0").select("file", "offset", "successor"))
    runs = members.groupBy("file", F.col("head").alias("offset")).agg(
        F.max_by("successor", "offset").alias("successor")
    )
    starts = runs.select("file", F.col("offset").alias("successor"))
    jumps = checkpointed(runs.where("successor > offset").join(starts, ["file", "successor"], "left_semi"))
    found = runs.where("offset = 0").select("file", "offset")
    while not jumps.isEmpty():
        reached = found.join(jumps, ["file", "offset"]).select("file", F.col("successor").alias("offset"))
        # Jumps double from round to round and starts lie behind what they reach: nothing comes twice.
        found = checkpointed(found.unionByName(reached))
        over = jumps.select("file", F.col("offset").alias("successor"), F.col("successor").alias("beyond"))
        jumps = checkpointed(
            jumps.join(over, ["file", "successor"]).select("file", "offset", F.col("beyond").alias("successor"))
        )
    heads = found.withColumnRenamed("offset", "head")
    return members.join(heads, ["file", "head"], "left_semi").select("file", "offset")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: ``file, offset, warc_type, record_id, target_uri, refers_to, payload_digest,
    http_length, payload``; the payload of a revisit is empty."""
    pieces = _pieces(spark, path)
    placed = checkpointed(candidates(pieces))
    chain = reachable(placed).withColumn("is_record", F.lit(True))
    marked = placed.join(chain, ["file", "offset"], "left")
    owner = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    record = F.when(F.col("is_record"), F.struct("offset", "successor"))
    owned = marked.withColumn("record", F.last(record, ignorenulls=True).over(owner)).where("offset >= 0")
    # A piece behind the end of the record before it belongs to none; the last record ends its file.
    parts = owned.where("offset < record.successor").select(
        "file", "at", "offset", F.col("record.offset").alias("start"), (F.expr("`end` >= record.successor") & F.col("is_record")).alias("is_whole")
    )
    parts = lookup_join(pieces.drop("block"), checkpointed(parts), ["file", "at"], "inner")
    whole = parts.where("is_whole").select("file", "start", "value")
    cut = (
        parts.where("is_whole is null or not is_whole")
        .groupBy("file", "start")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "value"))).alias("parts"))
        .select("file", "start", F.array_join(F.col("parts.value"), MAGIC).alias("value"))
    )
    header = F.substring_index("value", END, 1)
    split = whole.unionByName(cut).select(
        "file",
        F.col("start").alias("offset"),
        header.alias("header"),
        F.expr(f"substr(value, length(substring_index(value, '{_sql(END)}', 1)) + 5)").alias("block"),
    )
    http = F.substring_index("block", END, 1)
    payload = F.expr(
        f"substr(block, length(substring_index(block, '{_sql(END)}', 1)) + 5,"
        f" length(block) - length(substring_index(block, '{_sql(END)}', 1)) - 8)"
    )
    return split.select(
        "file",
        "offset",
        _field(F.col("header"), "WARC-Type").alias("warc_type"),
        _field(F.col("header"), "WARC-Record-ID").alias("record_id"),
        _field(F.col("header"), "WARC-Target-URI").alias("target_uri"),
        _field(F.col("header"), "WARC-Refers-To").alias("refers_to"),
        _field(F.col("header"), "WARC-Payload-Digest").alias("payload_digest"),
        _field(http, "Content-Length").try_cast("long").alias("http_length"),
        payload.alias("payload"),
    )


def _sql(text: str) -> str:
    return text.replace("\r", "\\r").replace("\n", "\\n")


def page_of(record_id: str) -> Column:
    return F.regexp_extract(record_id, rf"{ID_PREFIX}(-?[0-9]+)>", 1).try_cast("long")
