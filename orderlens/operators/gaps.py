"""Days between consecutive orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions import as_day, ascending, days_between


def longest_gaps(orders: DataFrame) -> DataFrame:
    """Per customer: number of dated orders and the longest gap in days between neighbours.

    Orders are first counted per customer and day. Several orders on one day only add
    gaps of 0, so the longest gap is the one between distinct days, and a customer's
    window holds at most one row per calendar day however many orders there are.
    """
    per_day = (
        orders.select("customer_id", as_day("order_date").alias("day"))
        .filter(F.col("day").isNotNull())
        .groupBy("customer_id", "day")
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    next_day = F.lead("day").over(Window.partitionBy("customer_id").orderBy(*ascending("day")))
    return (
        per_day.withColumn("next_day", next_day)
        .groupBy("customer_id")
        .agg(
            F.sum("orders").alias("order_count"),
            F.coalesce(F.max(days_between(F.col("day"), F.col("next_day"))), F.lit(0)).alias(
                "longest_gap"
            ),
        )
    )
