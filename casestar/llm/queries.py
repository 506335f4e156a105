"""Queries over the given tables, one per corpus operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casestar.llm import oracle
from casestar.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query under its name, with its SQL twin if there is one."""
    QUERIES[fn.__name__] = fn
    if sql := oracle.SQL.get(fn.__name__):
        ORACLE[fn.__name__] = sql
    return fn


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casestar.llm import quality_rules
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


@query
def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casestar.llm import order_minhash
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_lookup_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casestar.llm import lookup_sharding
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lookup_sharding.assign_shards(docs).select("doc_id", "shard")


@query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casestar.llm import decontaminate
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casestar.llm import mixing
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casestar.llm import secret_scan
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


@query
def op3_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casestar.llm import warc_zstd
    return warc_zstd.archive_report(table(spark, sf_dir, "pages"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casestar.llm import toxicity
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casestar.llm import quality_qda
    return quality_qda.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casestar.llm import token_counts
    return token_counts.token_report(table(spark, sf_dir, "documents"))


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casestar.llm import source_divergence
    return source_divergence.divergence_report(table(spark, sf_dir, "documents"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casestar.llm import hard_negatives
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


@query
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casestar.llm import language_id
    return language_id.language_report(table(spark, sf_dir, "documents"))
