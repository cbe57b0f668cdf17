"""Folders whose content is replaced as a whole.

``<path>/<version>`` holds one complete content and ``<path>/log`` one entry per finished version;
the newest entry is current. An entry is only written when its version is complete and has been
checked, so that a load or report that fails, or a driver that dies, leaves readers with what they
had. Every write is an ordinary Spark write and works in any store Spark can write to.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from orderlens.workspace import remove_directory

#: Versions that stay: the current one, and those that readers may still be reading.
KEPT = 2


def replace_content(
    spark: SparkSession,
    path: str,
    write: Callable[[str], None],
    check: Callable[[str], None] | None = None,
    keep: int = KEPT,
) -> None:
    """Write a new version by ``write(folder)`` and make it current.

    If ``write`` or ``check(folder)`` raises, the content stays as it was and the unfinished folder
    goes. After the switch all but the newest ``keep`` versions are removed.
    """
    if keep < 1:
        raise ValueError("at least one version must be kept")
    version = f"v{time.time_ns():020d}-{uuid4().hex[:8]}"
    folder = f"{path}/{version}"
    try:
        write(folder)
        if check is not None:
            check(folder)
    except Exception:
        remove_directory(spark, folder)
        raise
    spark.range(1).select(F.lit(version).alias("version")).write.parquet(f"{path}/log/{version}")
    for old in sorted(_finished(spark, path))[:-keep]:
        # the entry first: a version that has one is complete
        remove_directory(spark, f"{path}/log/{old}")
        remove_directory(spark, f"{path}/{old}")


def current_folder(spark: SparkSession, path: str) -> str:
    """The folder of the current version. Without any, ``AnalysisException`` (PATH_NOT_FOUND)."""
    return f"{path}/{max(_finished(spark, path))}"


def versions(spark: SparkSession, path: str) -> list[str]:
    """The finished versions, oldest first."""
    return sorted(_finished(spark, path))


def _finished(spark: SparkSession, path: str) -> list[str]:
    log = spark.read.schema("version string").option("recursiveFileLookup", True).parquet(f"{path}/log")
    return [row.version for row in log.collect()]  # a few names
