"""The ten operators as queries over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from curblake.llm import op1_topk, op2_urls, op3_bpe, op4_language, op5_quality, op6_mixing, op7_html, op8_near_dedup, op9_pii, op10_vectors


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_bpe.digests(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_language.identify(table(spark, sf_dir, "documents"))


def op5_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return op5_quality.score(docs, op5_quality.train(docs, table(spark, sf_dir, "labels")))


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_topk.search(table(spark, sf_dir, "embeddings"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_urls.judge(table(spark, sf_dir, "pages"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_mixing.summary(table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_html.extract(table(spark, sf_dir, "pages"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_near_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op9_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_pii.report(table(spark, sf_dir, "documents"))


def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_vectors.deduplicate(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_topk": op1_exact_topk,
    "op2_url_filter": op2_url_filter,
    "op3_bpe_codec": op3_bpe_codec,
    "op4_language_id": op4_language_id,
    "op5_quality_score": op5_quality_score,
    "op6_source_mix": op6_source_mix,
    "op7_html_text": op7_html_text,
    "op8_minhash_dedup": op8_minhash_dedup,
    "op9_pii_spans": op9_pii_spans,
    "op10_vector_dedup": op10_vector_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_topk": op1_topk.SQL,
    "op6_source_mix": op6_mixing.SQL,
    "op8_minhash_dedup": op8_near_dedup.SQL,
    "op10_vector_dedup": op10_vectors.SQL,
}
