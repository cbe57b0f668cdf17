"""Date expressions over text dates (yyyy-MM-dd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Year, month and day in full; Spark's own cast also takes a year alone, or a time after the day.
_DAY = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"


def as_day(text: str | Column) -> Column:
    """Text to date. Text that is no full date fails the query, with and without ANSI mode."""
    value = F.col(text) if isinstance(text, str) else text
    day = F.when(value.rlike(_DAY), value.try_cast("date"))
    failed = F.raise_error(F.concat(F.lit("not a date: "), value)).cast("date")
    return F.coalesce(day, F.when(value.isNotNull(), failed))


def days_between(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``."""
    return F.datediff(end, start)
