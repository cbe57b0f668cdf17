"""Sort keys in the order the reports promise.

A null counts as larger than every value: last when ascending, first when descending.
Spark's own defaults are the opposite, so every sort in the library goes through here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascending(*names: str) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in names]


def descending(*names: str) -> list[Column]:
    return [F.col(name).desc_nulls_first() for name in names]
