"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetlake.llm.common import read_table


def tokenizer(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, placed in sequences of at most 2048 tokens."""
    from streetlake.llm.packing import best_fit_pack
    return best_fit_pack(read_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated quality score of every document."""
    from streetlake.llm.quality_model import classify
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, scanned once per distinct text."""
    from streetlake.llm.secrets import count_kind, joined, scan
    found, _ = scan(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[count_kind(F.col("found"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined(F.col("found"), base_only=True), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every 50th vector."""
    from streetlake.llm.topk import exact_top_k
    return exact_top_k(read_table(spark, sf_dir, "embeddings"), 5, 50)


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and the decoded text of every document."""
    from streetlake.llm.bpe import bpe_round_trip
    return bpe_round_trip(read_table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op6_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without quotes, with what they reply to and their place in the thread."""
    from streetlake.llm.quotes import link_quotes
    return link_quotes(read_table(spark, sf_dir, "conversations"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    from streetlake.llm.licenses import scan_licenses
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    from streetlake.llm.neardup import near_duplicates
    return near_duplicates(read_table(spark, sf_dir, "documents"), 3, 85).drop("text_hash")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every URL."""
    from streetlake.llm.urls import judge_urls
    return judge_urls(read_table(spark, sf_dir, "pages"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules on every document."""
    from streetlake.llm.rules import quality_rules
    return quality_rules(read_table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    from streetlake.llm.repair import repair
    return repair(read_table(spark, sf_dir, "conversations"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences of term prices between sources, and between a source and its language."""
    from streetlake.llm.divergence import audit
    return audit(read_table(spark, sf_dir, "documents"))


def op13_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    import uuid

    from streetlake.llm.warc import read_warc, write_warc
    from streetlake.session import scratch_path
    path = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    write_warc(read_table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_best_fit_packing, op2_quality_classifier, op3_secret_scan, op4_exact_top_k, op5_bpe_round_trip,
             op6_quotation_linking, op7_license_scan, op8_minhash_near_dedup, op9_url_filter, op10_quality_rules,
             op11_conversation_repair, op12_source_divergence, op13_warc_round_trip]
    return {f.__name__: f for f in found} | {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    from streetlake.llm import oracle
    return oracle.oracle_sql()
