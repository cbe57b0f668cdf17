"""A corpus pipeline in five stages, each on what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import decontamination, jaccard_join, language_id, mixing, sharding
from orderlens.llm.corpus import small_batches
from orderlens.workspace import stored

SHARDS = 8


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go.

    Stored here, so that texts go to Python in small batches whatever settings the caller reads
    the result with. Python workers and Arrow buffers keep what a stage once took through the
    stages after it.
    """
    with small_batches(spark):
        return stored(language_id.keep_identified(docs), "identified")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays."""
    return jaccard_join.keep_first(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn to the target weights of source, language and topic."""
    return mixing.draw(docs).select(*docs.columns)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are dealt to shards of near equal bytes, equal texts together."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    return sharding.shard(docs, size, F.xxhash64("text"), F.col("doc_id"), SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]

#: Language models, similarity joins and raking are beyond SQL; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again.

    Python workers and Arrow buffers keep what a stage once took through the stages after it, so
    that texts go to Python in small batches in every stage.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with small_batches(spark):
        for name, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
