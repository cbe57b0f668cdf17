"""The four logical tables the reports read, and their declared column types.

``customer_id``, ``order_id`` and ``product_id`` are each unique in their own table
(``customer``, ``orders``, ``product_cor``); the reports join on them and say where more
is assumed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

CUSTOMER = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("job_title", T.StringType()),
    T.StructField("job_industry_category", T.StringType()),
    T.StructField("wealth_segment", T.StringType()),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("order_date", T.StringType()),  # text, yyyy-MM-dd
    T.StructField("order_status", T.StringType()),
    T.StructField("online_order", T.BooleanType()),
])

ORDER_ITEMS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", MONEY),
    T.StructField("item_list_price_at_sale", MONEY),
])

PRODUCT = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("brand", T.StringType()),
    T.StructField("list_price", MONEY),
])


@dataclass(frozen=True)
class ShopTables:
    """One DataFrame per logical table.

    ``product_cor`` is the corrected product list, one row per ``product_id``; the product table
    as loaded is not. Only the list-price and brand reports read it.
    """

    customer: DataFrame
    orders: DataFrame
    order_items: DataFrame
    product_cor: DataFrame | None = None
