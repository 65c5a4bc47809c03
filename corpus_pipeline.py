"""A training corpus from ``documents``: quality rules, near-duplicates, benchmark passages, source mix, shards.

Each stage works on all that its predecessor kept and is written as Parquet before the next one reads it.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontamination, divergence, mixing, neardup, sharding
from strata.llm.common import col, shared_dir, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return divergence.quality_rules(docs).filter("kept").select(*[col(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return neardup.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.filter("not contaminated").select(*[col(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document comes once for each pass over its source that takes it."""
    tokens = written(docs.select("doc_id", "source", mixing.word_count().alias("n_tokens")))
    plan = mixing.mixing_plan(tokens, "doc_id", "source", "n_tokens")
    return mixing.mix_sources(docs, plan).select(*[col(c) for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each row."""
    return sharding.shard(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: Weighted sampling of shingles and checksums have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = f"{shared_dir(spark)}/corpus-pipeline/{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
