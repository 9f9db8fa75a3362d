"""Registered queries of the training-data operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tastemap.llm import centroids, chat, codes, decontaminate, htmltext, jaccard, mixing, perplexity, secrets, substring, suffixes, tokens, warc

from tastemap.llm.oracle import oracle  # noqa: F401  (the queries' SQL)

Q = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.report(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.report(table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.report(table(spark, sf_dir, "pages"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(table(spark, sf_dir, "documents"))


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.report(table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


def op8_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.report(table(spark, sf_dir, "documents"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(table(spark, sf_dir, "embeddings"))


def op12_vector_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.report(table(spark, sf_dir, "embeddings"))


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(table(spark, sf_dir, "conversations"))


def registry() -> dict[str, Q]:
    found = (
        op1_jaccard_join,
        op2_substring_dedup,
        op3_html_extraction,
        op4_suffix_array_dedup,
        op5_token_output,
        op6_benchmark_decontamination,
        op7_warc,
        op8_mixing_sources,
        op9_secret_scans,
        op10_quality_rules,
        op11_centroid_clustering,
        op12_vector_compression,
        op13_chat_formatting,
    )
    return {f.__name__: f for f in found}
