"""Line amounts summed up along order lines -> orders -> customers.

Each level is aggregated *before* it is joined to the next. Spark combines on the map
side, so an order or customer that holds a large share of all lines travels as one
partial row per task, every join key is unique on both sides by the time it is joined,
and the strings of the customer table never ride along with the lines.

The measures carried at each level:

========================  ====================================================
``amount_sum``            exact sum of line amounts, null if every amount is null
``amount_max/amount_min`` largest and smallest line amount, already double: rounding
                          keeps order, so it may as well come first and travel lighter
``amount_count``          lines with an amount (the divisor of the average)
``line_count``            lines, with or without an amount
``order_count``           distinct orders (customer level only)
========================  ====================================================

A report that does not use a measure does not pay for it: Catalyst prunes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import as_double, line_amount


def order_totals(order_items: DataFrame, price: str, product: DataFrame | None = None) -> DataFrame:
    """One row of measures per ``order_id``.

    With ``product``, the price is a column of that table and lines whose product is
    unknown drop out; otherwise it is a column of the lines themselves.
    """
    if product is None:
        lines = order_items.select("order_id", "quantity", price)
    else:
        lines = order_items.select("order_id", "product_id", "quantity").join(
            product.select("product_id", price), "product_id"
        )
    return (
        lines.select("order_id", line_amount(price).alias("amount"))
        .groupBy("order_id")
        .agg(
            F.sum("amount").alias("amount_sum"),
            F.max(as_double(F.col("amount"))).alias("amount_max"),
            F.min(as_double(F.col("amount"))).alias("amount_min"),
            F.count("amount").alias("amount_count"),
            F.count(F.lit(1)).alias("line_count"),
        )
    )


def customer_totals(orders: DataFrame, per_order: DataFrame) -> DataFrame:
    """One row of measures per ``customer_id`` that has at least one order line."""
    return (
        orders.select("order_id", "customer_id")
        .join(per_order, "order_id")
        .groupBy("customer_id")
        .agg(*_merged_measures(), F.countDistinct("order_id").alias("order_count"))
    )


def spend_by_customer(
    customer: DataFrame, per_customer: DataFrame, columns: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Customer columns next to the customer's measures, grouped by all of ``columns``.

    ``how="left"`` keeps customers without any line; their measures are null. The final
    grouping merges repeated customer rows and needs no shuffle after the join.
    """
    keys = ["customer_id", *columns]
    return (
        customer.select(keys)
        .join(per_customer, "customer_id", how)
        .groupBy(keys)
        .agg(*_merged_measures(), F.max("order_count").alias("order_count"))
    )


def _merged_measures() -> list[Column]:
    return [
        F.sum("amount_sum").alias("amount_sum"),
        F.max("amount_max").alias("amount_max"),
        F.min("amount_min").alias("amount_min"),
        F.sum("amount_count").alias("amount_count"),
        F.sum("line_count").alias("line_count"),
    ]
