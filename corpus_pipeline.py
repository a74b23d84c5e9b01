"""A corpus pipeline: toxic and low-quality documents go, near-duplicates and repeated passages go, the rest is packed.

Each stage takes what its predecessor left, as a table with the columns of ``documents``; the last returns the pieces of
the packed sequences. Every stage defines its result for nulls, empty texts and repeated rows as its operator does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattledger.llm.common import table
from wattledger.llm.near_copies import one_of_each_group
from wattledger.llm.packing import pack_documents
from wattledger.llm.quality import passes_quality
from wattledger.llm.substring import without_repeats
from wattledger.llm.toxicity import is_clean
from wattledger.plans.storage import scratch_dir, written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    return docs.where(is_clean(docs, table(spark, sf_dir, "labels")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose log-likelihood ratio reaches the threshold."""
    return docs.where(passes_quality(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash links, and five-word Jaccard links of 0.8 and more."""
    return one_of_each_group(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 50 words and more that a document with a smaller id has."""
    return without_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 1,024 tokens."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", packing),
]

ORACLE_SQL = None  # trees, hashes and tokenizers are beyond SQL; tests compare the stages with plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet below ``spark.checkpoint.dir`` and read again."""
    base = scratch_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"{base}/{number}")
    return docs
