"""The registered corpus queries, each over its whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from orderlens.llm import (
    centroid_tree,
    decontamination,
    fingerprints,
    jaccard_join,
    language_id,
    line_dedup,
    minhash,
    mixing,
    oracle,
    quality,
    sharding,
    suffix_dedup,
    vector_codes,
    warc,
)
from orderlens.llm.corpus import id_and_text, table, utf8_size
from orderlens.workspace import new_directory


def op6_raked_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.draw(table(spark, sf_dir, "documents"))
    return drawn.select("doc_id", "source", "lang", F.col("__keep__").alias("keep"))


def op7_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.drop_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op8_language_bitmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    told = language_id.predict(documents, language_id.learn_from_folds(documents))
    return told.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op1_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_next(table(spark, sf_dir, "documents"))


def op2_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    rows = id_and_text(table(spark, sf_dir, "documents")).select(
        "doc_id",
        (utf8_size(text) + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"),
    )
    dealt = sharding.shard(rows, F.col("size"), F.col("text_key"), F.col("doc_id"), 8)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.drop_repeated_runs(table(spark, sf_dir, "documents")))


def op4_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"), new_directory(spark, "warc"))


def op11_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_dictionary_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_vantage_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_tree.cluster(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_imatch_fingerprints,
        op2_histogram_shards,
        op3_line_runs,
        op4_jaccard_components,
        op5_warc_revisits,
        op6_raked_mixture,
        op7_suffix_repeats,
        op8_language_bitmask,
        op9_template_leaks,
        op10_quality_discriminant,
        op11_minhash_components,
        op12_dictionary_codes,
        op13_vantage_clusters,
        pipeline,
    )
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {
        "op4_jaccard_components": oracle.jaccard_components(75, kept=False),
        "op5_warc_revisits": oracle.WARC_REVISITS.format(more=", TRUE AS intact"),
        "op11_minhash_components": oracle.jaccard_components(85, kept=True),
        "op12_dictionary_codes": oracle.dictionary_codes(),
        "op13_vantage_clusters": oracle.centroid_clusters(),
    }
