"""From documents to training tokens: reject toxic texts, drop copies and near copies, mix, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relayframe.llm import bpe, exact_dedup, mixing, simhash, toxicity
from relayframe.llm.common import table
from relayframe.llm.queries import BYTE_BPE, TOXIC_FROM, tokenizer_path
from relayframe.session import scratch_path, share_package


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents, then drops what scores as toxic."""
    share_package(spark)
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, score_col="toxicity_score")
    return scored.where(F.col("toxicity_score") < TOXIC_FROM).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_package(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_package(spark)
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_package(spark)
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, packed, and whether they decode to its text again."""
    share_package(spark)
    found = bpe.encode_texts(docs.select("doc_id", "lang", "source", "text"), tokenizer_path(BYTE_BPE), decode=True)
    return found.select(
        "doc_id",
        "lang",
        "source",
        bpe.n_tokens().alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("decodes"),
        "ids",
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: SQL has no equivalent of the stages; tests/llm/test_pipeline.py compares them with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
