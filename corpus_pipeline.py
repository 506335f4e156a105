"""Corpus pipeline: filter, deduplicate, decontaminate, mix and shard documents.

Edge cases, for every stage: an empty table gives an empty result; whole texts are
used, however long; other columns pass through, whatever their names. Null and blank
texts do not pass the first stage; given to a later one, they form no group (one row
per id stays), are not contaminated, and are taken by no mix. Rows with a null id or
source are rows like others: a null id names no group but is kept once per text, a null
source is a source of its own, and each has a shard. Repeated rows pass the first stage
each, are one document after the second, and count each in the stages after it. Ties
go to the smallest id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casestar.llm import decontaminate, lookup_sharding, mixing, order_minhash, quality_rules
from casestar.llm.common import table
from casestar.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules' label model keeps."""
    return quality_rules.keep_good(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that with the smallest doc_id."""
    return order_minhash.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a row per document and pass with the words it takes."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents with their output shard."""
    return lookup_sharding.assign_shards(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", deduplicate),
    ("decontamination", clean),
    ("mixing", mix),
    ("sharding", shard),
]

#: Near-duplicate groups are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
