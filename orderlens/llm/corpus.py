"""What several corpus operators share: tables, empty texts and deterministic folds."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(documents: DataFrame) -> DataFrame:
    """Only doc_id and text, a missing text as the empty one; other columns cannot clash."""
    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of an id: CRC-32 of its decimal text, modulo the number of folds."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def utf8_size(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def utf8_sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 512) -> Iterator[None]:
    """Texts reach Python so many rows at a time in the actions within; the session's setting comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of so many rows, so that what is made of a part stays small."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)
