"""Finished reports as CSV with a header in every file, replaced as a whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.sources.versions import KEPT, current_folder, replace_content

# Enough for a double of any size that reads well without an exponent.
_PLAIN = T.DecimalType(38, 18)


def save_report(report: DataFrame, path: str, keep: int = KEPT) -> None:
    """Replace the report at ``path``, keeping its row order.

    The files go to a folder of their own (``report_folder`` names it) that becomes the report when
    all are written, so that a failed run leaves the report as it was.

    Adaptive execution merges a small result into one file; a large one stays in several
    files whose names sort in row order. Doubles keep all their digits: reading back gives the
    same number. They are written without an exponent unless very small or large; infinities
    and NaN are written as Java names them. A null and an empty text are both an empty field,
    which reads as null. Where it is alone on its line it is written as ``""``, and a lone text is
    always quoted, because readers of CSV pass over blank lines. Blanks around a text stay.
    """
    columns = [_written(field) for field in report.schema]
    lone_text = [field.dataType for field in report.schema] == [T.StringType()]
    if len(columns) == 1:
        columns = [F.coalesce(columns[0].cast("string"), F.lit(""))]
    files = report.select([column.alias(name) for column, name in zip(columns, report.columns)])

    def write(folder: str) -> None:
        files.write.csv(
            folder, header=True, quote='"', escape='"', encoding="UTF-8", quoteAll=lone_text,
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )

    replace_content(report.sparkSession, path, write, keep=keep)


def _written(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    return _digits(column) if isinstance(field.dataType, T.DoubleType) else column


def _digits(number: Column) -> Column:
    shortest = number.cast("string")
    padded = shortest.try_cast(_PLAIN).cast("string")
    plain = F.regexp_replace(F.regexp_replace(padded, "0+$", ""), r"\.$", ".0")
    return F.when(shortest.contains("E") & (plain.try_cast("double") == number), plain).otherwise(shortest)


def report_folder(spark: SparkSession, path: str) -> str:
    """Where the files of the report at ``path`` lie. A report never saved raises PATH_NOT_FOUND."""
    return current_folder(spark, path)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A saved report. One never saved raises ``AnalysisException`` (PATH_NOT_FOUND)."""
    return spark.read.csv(
        report_folder(spark, path), schema=schema, header=True, quote='"', escape='"',
        encoding="UTF-8", multiLine=True, mode="FAILFAST", enforceSchema=False,
    )
