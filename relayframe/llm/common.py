"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: space and the five control characters of ASCII white space (``bytes.split``).
BLANK = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of maximal runs of other characters than blanks; 0 for null."""
    parts = F.split(F.coalesce(text, F.lit("")), BLANK + "+")
    edges = F.when(parts[0] == "", 1).otherwise(0) + F.when(
        (F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1
    ).otherwise(0)
    return (F.size(parts) - edges).cast("long")


def partitions_for(rows: int, rows_per_task: int) -> int:
    return max(1, -(-rows // rows_per_task))
