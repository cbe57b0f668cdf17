"""Ranking steps. Every sort key list must end in a unique key so ties are settled.

None of them moves a whole group to one task: Spark keeps the first n rows of each
group in every map task before the shuffle (``WindowGroupLimit``), and the first n rows
of the whole table in every task before the merge (``TakeOrderedAndProject``).
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.workspace import stored


def first_n(rows: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return rows.orderBy(*order).limit(n)


def top_n_per_group(
    rows: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group, numbered from 1 in column ``rank``."""
    numbered = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn(rank, numbered).filter(F.col(rank) <= n)


def nth_per_group(
    rows: DataFrame, group: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    """The ``n``-th row of each group; groups with fewer rows are absent."""
    numbered = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn("_rank", numbered).filter(F.col("_rank") == n).drop("_rank")


def both_ends(
    rows: DataFrame,
    low: Sequence[Column],
    high: Sequence[Column],
    n: int,
    low_label: str,
    high_label: str,
    into: str,
) -> DataFrame:
    """The first ``n`` rows in ``low`` order and in ``high`` order, labelled.

    A row that is within both ends appears once, under ``low_label``. Numbering the whole
    table by a window would bring all of it into one task; two bounded top-n passes give
    the same rows, and only their 2n results are grouped afterwards.
    """
    ends = first_n(rows, low, n).withColumn("_low", F.lit(True)).unionAll(
        first_n(rows, high, n).withColumn("_low", F.lit(False))
    )
    is_low = F.col("_low")
    return (
        ends.groupBy(*rows.columns)
        .agg(F.max("_low").alias("_low"))
        .withColumn(into, F.when(is_low, low_label).when(~is_low, high_label))
        .drop("_low")
    )


def numbered(rows: DataFrame, into: str = "position") -> DataFrame:
    """The rows with their place, from 1, in the order they come in.

    A sorted table lies in partitions that follow each other, so that a row's place is its place in
    its partition and the rows of the partitions before; only these counts, one per partition, are
    gathered. The rows are stored first: places hold for one arrangement of them.
    """
    whole = rows.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("place"))
    placed = stored(whole, "ordered").withColumn("part", F.shiftright("place", 33))
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).orderBy("part").collect()
    ends = accumulate(row.rows for row in counts)
    before = [(row.part, end - row.rows) for row, end in zip(counts, ends)]
    offsets = rows.sparkSession.createDataFrame(before, "part BIGINT, before BIGINT")
    position = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    return placed.join(F.broadcast(offsets), "part").select("row.*", position.alias(into))
