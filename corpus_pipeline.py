"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing, encoding.

Each stage takes the documents its predecessor kept and returns documents; the
last one returns them encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaferry.llm import bpe, line_dedup, mixing, near_dedup, quality_rules
from metaferry.sources.staging import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current quality policy."""
    return quality_rules.accepted(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source."""
    return line_dedup.without_boilerplate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.without_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with token ids, the number of them, and the hash of what they decode to.

    Columns ``ids``, ``n_tokens`` and ``decoded_sha256`` of the input are replaced.
    """
    coded = bpe.encode(docs, decoded="decoded")
    return coded.withColumn("n_tokens", F.size("ids").cast("bigint")).withColumn(
        "decoded_sha256", F.sha2("decoded", 256)
    ).drop("decoded")


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near dedup", near_duplicates),
    ("mixing", mixture),
    ("encoding", tokens),
]
# Encoding has no SQL form; tests/llm/test_brute_force.py computes every stage plainly.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every result is written and read again. Runs jobs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
