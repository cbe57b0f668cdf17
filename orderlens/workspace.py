"""Where intermediate tables may be written."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def application_directory(spark: SparkSession) -> str:
    """This application's folder below one that the driver and every executor reach.

    That is ``spark.checkpoint.dir``; a session without one has the warehouse, which a
    cluster shares as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/orderlens/{spark.sparkContext.applicationId}"


def new_directory(spark: SparkSession, label: str) -> str:
    """A fresh directory name in this application's folder."""
    return f"{application_directory(spark)}/{label}-{uuid4().hex}"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written once and read again: later steps and retries read the files.

    What was shuffled for it is deleted as soon as it is written.
    """
    spark = frame.sparkSession
    path = new_directory(spark, label)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session has this setting in the actions within, and its own again afterwards."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def remove_directory(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store its path names, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clear_work(spark: SparkSession) -> None:
    """Delete everything this application stored on the way; for when no result is read any more."""
    remove_directory(spark, application_directory(spark))
