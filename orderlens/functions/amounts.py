"""Money expressions.

Amounts stay decimal through every sum, so a total does not depend on how rows were
partitioned or retried, and become double only in the finished report.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def line_amount(price: str) -> Column:
    """Quantity times the given price column."""
    return F.col("quantity") * F.col(price)


def or_zero(total: Column) -> Column:
    return F.coalesce(total, F.lit(0))


def as_double(total: Column) -> Column:
    return total.cast("double")
