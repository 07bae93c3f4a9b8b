"""The corpus pipeline: documents to packed token sequences, a stored table after every stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curbflow.llm import mixing, pii, quality, simhash
from curbflow.llm.common import scratch, session, table
from curbflow.llm.queries import packed


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counting rules and the likelihood ratio keep."""
    return quality.keep_good(docs, quality.trusted_ids(table(spark, sf_dir, "labels")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id."""
    return simhash.keep_first(docs)


def pii_sanitised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, identifiers and the terms that disclose them replaced."""
    return pii.sanitised(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose token weights meet the targets of source, language and topic."""
    return mixing.sample(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("pii_sanitised", pii_sanitised),
    ("source_mixing", source_mixing),
    ("packing", packing),
]

#: Hashed scores, fingerprints and tokenizers are beyond SQL; a test follows the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read back as the next one's input."""
    docs = table(session(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
