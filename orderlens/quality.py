"""The result gate: every saved report must hold at least one row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.sources import read_report, report_folder


class EmptyReports(ValueError):
    """Reports without rows; ``failed`` holds their names and row counts."""

    def __init__(self, failed: Sequence[tuple[str, int]]) -> None:
        super().__init__(f"reports with 0 rows: {', '.join(name for name, _ in failed)}")
        self.failed = list(failed)


def report_counts(
    spark: SparkSession, reports: Mapping[str, tuple[str, T.StructType]]
) -> DataFrame:
    """``(report, row_count, passed)`` per report, given its path and schema.

    A report that was never written counts 0; any other read problem is raised.
    """
    counts = [
        _saved_rows(spark, path, schema)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("report"), "row_count", (F.col("row_count") > 0).alias("passed"))
        for name, (path, schema) in reports.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def failures(counts: DataFrame) -> DataFrame:
    """``(report, row_count)`` of the reports that did not pass."""
    return counts.filter(~F.col("passed")).select("report", "row_count")


def require_non_empty(counts: DataFrame) -> None:
    """Raise ``EmptyReports`` naming every report without rows."""
    failed = [(row.report, row.row_count) for row in failures(counts).collect()]
    if failed:
        raise EmptyReports(failed)


def _saved_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        report_folder(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(0)
    return read_report(spark, path, schema)
