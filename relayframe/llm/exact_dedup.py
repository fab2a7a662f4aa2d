"""Exact duplicates by progressive refinement: length, then a hash of the prefix, then a hash of all.

Each level groups only what the level before could not tell apart. The first pass keeps three numbers
a row; whole texts are hashed only in the second pass, for rows whose length and prefix occur twice.
Everything is DataFrame functions.

Defined results: a null text counts as empty, and empty texts equal each other. The largest id of a
group stays; null ids count as smallest. Rows that repeat the largest id too (repeated rows) stay once.
Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relayframe.llm.common import text_or_empty
from relayframe.session import checkpointed, lookup_join

PREFIX_CHARS = 256
LEVEL_KEYS = ["n_bytes", "prefix_hash"]


def _level_keys(text_col: str):
    text = text_or_empty(text_col)
    return (
        F.octet_length(text).alias("n_bytes"),
        F.xxhash64(F.substring(text, 1, PREFIX_CHARS)).alias("prefix_hash"),
    )


def _full_hash(text_col: str):
    return F.sha2(text_or_empty(text_col), 256)


def _ambiguous(keys: DataFrame) -> DataFrame:
    """Pairs of length and prefix hash that occur twice; prefixes are grouped only where lengths repeat."""
    lengths = keys.groupBy("n_bytes").count().where("count > 1").select("n_bytes")
    prefixes = lookup_join(keys, lengths, ["n_bytes"], "left_semi").groupBy(*LEVEL_KEYS).count()
    return checkpointed(prefixes.where("count > 1").select(*LEVEL_KEYS))


def duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_digest: bool = False
) -> DataFrame:
    """One row per input row: the id, ``keep_id`` (the group's largest id), ``group_size`` and ``kept``.

    ``with_digest`` adds ``text_sha256`` of every row, which has to read every text once more than the
    grouping needs; the grouping itself does not use it.
    """
    digest = _full_hash(text_col) if with_digest else F.lit(None).cast("string")
    ids = F.col(id_col).alias("id")
    # Written once: the levels, and the rows that no level groups, all come from these few numbers.
    keys = checkpointed(docs.select(ids, *_level_keys(text_col), digest.alias("digest")))
    ambiguous = _ambiguous(keys)
    alone = lookup_join(keys, ambiguous, LEVEL_KEYS, "left_anti").select(
        "id",
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "digest",
    )
    read = docs.select(ids, *_level_keys(text_col), F.col(text_col).alias("text"))
    rows = (
        lookup_join(read, ambiguous, LEVEL_KEYS, "left_semi")
        .groupBy("n_bytes", _full_hash("text").alias("full_hash"), "id")
        .agg(F.count("*").alias("rows"))
    )
    groups = rows.groupBy("n_bytes", "full_hash").agg(
        F.max("id").alias("keep_id"), F.sum("rows").alias("group_size")
    )
    same = ["n_bytes", "full_hash"]
    grouped = rows.join(groups, same).select(
        "id",
        "keep_id",
        "group_size",
        "full_hash",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("copy"),
    )
    grouped = grouped.select(
        "id",
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.col("full_hash").alias("digest"),
    )
    out = alone.unionByName(grouped).withColumnRenamed("id", id_col)
    return out.withColumnRenamed("digest", "text_sha256") if with_digest else out.drop("digest")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's rows and columns with one row of each group of equal texts: that of the largest id,
    among several such that whose other columns, in order, are largest."""
    keys = checkpointed(docs.select(*_level_keys(text_col)))
    ambiguous = _ambiguous(keys)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    orderable = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind and c != id_col]
    rows = docs.select(*_level_keys(text_col), row.alias("row"))
    alone = lookup_join(rows, ambiguous, LEVEL_KEYS, "left_anti").select("row.*")
    text = F.coalesce(F.col("row").getField(text_col), F.lit(""))
    order = F.struct(*[F.col("row").getField(c).alias(f"c{i}") for i, c in enumerate([id_col, *orderable])])
    grouped = (
        lookup_join(rows, ambiguous, LEVEL_KEYS, "left_semi")
        .groupBy("n_bytes", F.sha2(text, 256).alias("full_hash"))
        .agg(F.max_by("row", order).alias("row"))
        .select("row.*")
    )
    return alone.unionByName(grouped)
