"""Documents to packed training sequences: reject toxic ones, keep one of each group of near
duplicates, reject benchmark leaks, mask personal data, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronicle.llm import common, decontam, minhash, packing, pii, toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar, learned from the labels of these documents, does not reject."""
    return toxicity.clean_documents(docs, common.table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id: five-word shingles, similarity 0.8."""
    return minhash.kept_documents(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words fewer than one in twenty stand in a benchmark passage."""
    return decontam.clean_documents(docs, common.table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    return pii.masked_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: No SQL: tokenization and the learned grammar have none. tests/llm/test_pipeline.py holds it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each one's documents are written to the shared checkpoint folder and read by the next."""
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = common.checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
