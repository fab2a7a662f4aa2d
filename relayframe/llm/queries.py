"""The operators over their whole tables, with production parameters, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relayframe.llm import (
    alignment,
    bpe,
    conversations,
    exact_dedup,
    jaccard_join,
    mixing,
    pii,
    simhash,
    substring,
    token_counts,
    topk,
    toxicity,
    warc,
)
from relayframe.llm.common import table
from relayframe.session import scratch_path, share_package

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
TOXIC_FROM = 0.3


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["is_base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{name}") for i, name in enumerate(pii.BASE)
    ]
    return found.select(
        F.col("id").alias("doc_id"),
        *counts,
        F.sha2(pii.spans_text(base), 256).alias("base_sha256"),
        pii.spans_text(F.col("spans")).alias("spans"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path(PIECES))
    return found.withColumnRenamed("id", "doc_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_components(simhash.fingerprints(table(spark, sf_dir, "documents")))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_pages(table(spark, sf_dir, "pages"), path)
    records = warc.read_records(spark, path)
    revisit = F.col("warc_type") == "revisit"
    return records.select(
        warc.page_of("record_id").alias("page_id"),
        F.when(revisit, F.col("http_length")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.substring_index("payload_digest", ":", -1))
        .otherwise(F.sha2("payload", 256))
        .alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        F.when(revisit, warc.page_of("refers_to")).alias("refers_to"),
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"), with_digest=True)


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bpe.encode_texts(docs, tokenizer_path(BYTE_BPE), decode=True)
    return found.select(
        "doc_id",
        bpe.n_tokens().alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        (~toxicity.is_training()).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = mixing.mix_units(table(spark, sf_dir, "documents"))
    rows = units.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return rows.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeated(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = F.lit(" ")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    rows = rows.withColumn("damage", F.crc32(place) % 20)
    stays = F.col("damage") != 0
    role, text = (F.coalesce(c, space) for c in ("role", "text"))
    damaged = rows.where(stays).select(
        "conv_id",
        "turn",
        F.when(F.col("damage") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("damage") == 1, "")
        .when(F.col("damage") == 2, F.translate(text, ".!?", ""))
        .otherwise(text)
        .alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("damage") == 3, 2).otherwise(1))).alias("copy"),
    )
    found = conversations.reports(conversations.repair(damaged))
    zeros = [F.lit(0).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing_left = (
        rows.groupBy("conv_id")
        .agg(F.max(stays).alias("stays"))
        .where("not stays")
        .select("conv_id", *zeros, F.lit("").alias("audit"), F.sha2(F.lit(""), 256).alias("repaired_sha256"))
    )
    return found.unionByName(nothing_left)


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = alignment.align(docs, tokenizer_path(BYTE_BPE), tokenizer_path(PIECES))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    found = alignment.with_counts(aligned.select("*", digest).drop("groups"))
    return found.withColumnRenamed("id", "doc_id").drop("row")


def _shared(query: Query) -> Query:
    return lambda spark, sf_dir: query(share_package(spark), sf_dir)


QUERIES: dict[str, Query] = {
    q.__name__: _shared(q)
    for q in (
        op1_pii,
        op2_token_counts,
        op3_simhash,
        op4_warc,
        op5_exact_dedup,
        op6_topk,
        op7_bpe,
        op8_toxicity,
        op9_mixing,
        op10_substring_dedup,
        op11_conversation_repair,
        op12_jaccard_join,
        op13_alignment,
    )
}

ORACLE: dict[str, str] = {
    "op4_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
             g AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p),
             r AS (SELECT *, strlen(h) >= 100 AND page_id IS DISTINCT FROM first AS again FROM g)
        SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest,
               CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN first END AS refers_to
        FROM r
    """,
    "op5_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
        FROM d WINDOW g AS (PARTITION BY t)
    """,
    "op6_topk": """
        WITH v AS (
            SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
            SELECT q.n, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.n <> c.n
        ),
        r AS (
            SELECT query_id, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id)::INTEGER AS rank,
                   vec_id, score
            FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
}
