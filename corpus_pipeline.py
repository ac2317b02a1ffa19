"""Corpus pipeline: documents to packed training sequences.

``STAGES`` run in order; each result is written as Parquet and read again as
the next stage's documents.  All but the last return the columns of documents.
Defined results: an empty table passes through every stage; null texts are
empty texts and fail the quality rules; rows without a doc_id are judged like
others and never count as duplicates; repeated rows are one document to the
near-duplicate stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streetlake.llm import neardup, packing, quality_model, rules, secrets
from streetlake.llm.common import read_table, stage
from streetlake.llm.queries import tokenizer

def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return rules.keep_documents(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated quality score is 0.3 or more."""
    return quality_model.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8)."""
    return neardup.drop_near_duplicates(docs, 5, 80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret overwritten."""
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences of 2048."""
    return packing.best_fit_pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

# Training, MinHash and BPE ids have no SQL form; tests/llm holds the stages in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
