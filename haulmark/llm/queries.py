"""Registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.llm import (
    bpe, conversations, extraction, fingerprints, importance, pii, sharding, simhash, spelling, suffix_dedup, templates, token_counts,
    token_files,
)
from haulmark.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def op6_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = templates.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("h")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shards(table(spark, sf_dir, "documents"), 40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.document_fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprints.hex_of(F.col("fp")).alias("fingerprint"),
        fingerprints.hex_of(F.col("edited_fp")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        fingerprints.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        "n_within",
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(table(spark, sf_dir, "documents"))
    counts = [F.size(pii.of_kind("base", no)).cast("bigint").alias(f"n_{kind}") for no, kind in enumerate(pii.KINDS)]
    return found.select(
        "doc_id", *counts,
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.array_sort(F.concat("base", "found"))).alias("spans"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.cleaned(table(spark, sf_dir, "conversations"))
    return conversations.repaired(conversations.damaged(rows))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(spelling.word_counts(table(spark, sf_dir, "documents"), shortest=5, least=3, every=97))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.main_text(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_simhash, op3_importance, op4_token_counts, op5_token_files, op6_templates, op7_sharding,
        op8_fingerprints, op9_bpe, op10_pii, op11_conversation_repair, op12_spelling_variants,
        op13_main_text,
    )
}
ORACLE: dict[str, str] = {}
