"""The registered queries of this package, with production parameters over whole tables, and SQL where it can say the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm import (
    conversations,
    decontamination,
    extraction,
    license_scan,
    line_dedup,
    lm_scoring,
    merkle,
    mixing,
    oracles,
    quality,
    simhash,
    token_counts,
    toxicity,
    warc,
)
from recurra.llm.common import read_table
from recurra.session import cut_lineage, shared_dir
from recurra.sources.files import removed

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.dedup_lines(read_table(spark, folder, "documents"))
    return found.select("row.doc_id", "n_lines", "n_exact", "n_near", F.col("kept_text").alias("text"))


def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = extraction.extract(read_table(spark, folder, "pages"), keep=["page_id", "url"])
    return found.select("page_id", "url", F.col("extracted").alias("text"), F.length("extracted").cast("bigint").alias("n_chars"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_components(read_table(spark, folder, "documents"))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, folder, "documents"))


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    manifest = warc.write_archives(read_table(spark, folder, "pages"), archives)
    found = warc.read_archives(manifest, archives, with_payload=False)
    # The archives go once what was read from them is kept.
    kept = cut_lineage(found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    removed(spark, archives)
    return kept


def op6_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_documents(read_table(spark, folder, "documents"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers  # only this query needs the vocabulary files

    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts.count_tokens(read_table(spark, folder, "documents"), path)


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    return decontamination.report(decontamination.find_contamination(docs, benchmark, keep=["doc_id"]))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.quality_rules(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("row.doc_id", *counts, "base_failed", "kept", "score")


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.mix(read_table(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(read_table(spark, folder, "documents"))


def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    found = toxicity.score_toxicity(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"), keep=["doc_id"])
    return found.select("row.doc_id", "held_out", "score", "predicted")


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair_conversations(read_table(spark, folder, "conversations"), damage=True)


def queries() -> dict[str, Query]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_html_extraction": op2_html_extraction,
        "op3_simhash": op3_simhash,
        "op4_license_scan": op4_license_scan,
        "op5_warc": op5_warc,
        "op6_lm_scoring": op6_lm_scoring,
        "op7_token_counts": op7_token_counts,
        "op8_decontamination": op8_decontamination,
        "op9_quality_rules": op9_quality_rules,
        "op10_mixing": op10_mixing,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_toxicity": op12_toxicity,
        "op13_conversation_repair": op13_conversation_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": oracles.LINE_DEDUP,
        "op4_license_scan": oracles.license_scan_sql(),
        "op5_warc": oracles.WARC,
        "op8_decontamination": oracles.DECONTAMINATION,
        "op11_merkle_manifest": oracles.MERKLE,
        "op13_conversation_repair": oracles.CONVERSATIONS,
    }
