"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    embeddings,
    kmeans,
    licenses,
    lines,
    mixing,
    ngram_join,
    packing,
    quality,
    quality_model,
    repeats,
    toxicity,
    turns,
    warc,
)
from .common import table


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = lines.dedup_lines(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, folder, "documents")))


def op6_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_model.classify(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    )


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, folder, "documents"))
    share = F.when(F.col("n_bytes") > 0, F.col("n_removed") / F.col("n_bytes")).otherwise(0.0)
    return cut.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        "kept_sha256",
        share.alias("removed_share"),
        "n_shared_words",
    )


def op10_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    joined = ngram_join.join(table(spark, folder, "documents"), width=3, share=90)
    return joined.select("doc_id", "n_shingles", "component_id")


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    found = turns.repair(turns.damage(table(spark, folder, "conversations")))
    return found.select(
        "conv_id",
        "gaps",
        "blank",
        "duplicate",
        "truncated",
        "illegal",
        "cost",
        "audit",
        "repaired_sha256",
    )


def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def op13_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return kmeans.digest(*kmeans.cluster(table(spark, folder, "embeddings")))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_mixing,
        op2_quality_rules,
        op3_best_fit_packing,
        op4_line_dedup,
        op5_license_scan,
        op6_embedding_dedup,
        op7_quality_classifier,
        op8_toxicity,
        op9_repeated_strings,
        op10_ngram_jaccard,
        op11_conversation_repair,
        op12_warc,
        op13_centroid_clustering,
    ]
    return {query.__name__: query for query in found}


def sql_texts() -> dict[str, str]:
    return {
        "op1_mixing": mixing.SQL,
        "op2_quality_rules": quality.SQL,
        "op4_line_dedup": lines.SQL,
        "op5_license_scan": licenses.SQL,
        "op11_conversation_repair": turns.SQL,
        "op12_warc": warc.SQL,
        "op13_centroid_clustering": kmeans.sql(),
    }
