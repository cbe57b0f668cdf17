"""The twelve reports.

Each takes the tables and returns a lazy DataFrame; literals of the business question
are parameters. Money columns are double in the result. Where a question leaves ties
open, the unique id (or, without one, the names) settles them.

Two price bases exist: the product's list price and the price at sale stored on the
order line. Reports with ``list_price`` in their name, and all others unless they say
"at sale", use the list price.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions import (
    as_day,
    as_double,
    ascending,
    descending,
    line_amount,
    or_zero,
)
from orderlens.operators import (
    both_ends,
    customer_totals,
    first_n,
    longest_gaps,
    nth_per_group,
    order_totals,
    spend_by_customer,
    top_n_per_group,
)
from orderlens.tables import ShopTables

LIST_PRICE = "list_price"
SALE_PRICE = "item_list_price_at_sale"
NAMES = ("first_name", "last_name")


def clients_by_industry(tables: ShopTables) -> DataFrame:
    """Number of clients per industry, most first."""
    return (
        tables.customer.groupBy("job_industry_category")
        .agg(F.count(F.lit(1)).alias("client_count"))
        .orderBy(*descending("client_count"), *ascending("job_industry_category"))
    )


def monthly_revenue_by_industry(tables: ShopTables, status: str = "Approved") -> DataFrame:
    """List-price revenue of orders with the given status per year, month and industry.

    The status filter drops many lines, so the orders are joined to the lines before the
    lines are priced: only lines of wanted orders reach the product join.
    """
    day = as_day("order_date")
    orders = tables.orders.filter(F.col("order_status") == status).select(
        "order_id", "customer_id", F.year(day).alias("year"), F.month(day).alias("month")
    )
    keys = ["year", "month", "job_industry_category"]
    return (
        orders.join(tables.customer.select("customer_id", keys[-1]), "customer_id")
        .join(tables.order_items.select("order_id", "product_id", "quantity"), "order_id")
        .join(_products(tables).select("product_id", LIST_PRICE), "product_id")
        .groupBy(keys)
        .agg(as_double(F.sum(line_amount(LIST_PRICE))).alias("total_revenue"))
        .orderBy(*ascending(*keys))
    )


def online_orders_by_brand(
    tables: ShopTables, status: str = "Approved", only_industry: str | None = None
) -> DataFrame:
    """Distinct online orders with the given status per brand; brands without any show 0.

    By default every client's orders count. ``only_industry`` restricts them to clients
    of one industry.
    """
    wanted = tables.orders.filter((F.col("order_status") == status) & F.col("online_order"))
    if only_industry is not None:
        clients = tables.customer.filter(F.col("job_industry_category") == only_industry)
        wanted = wanted.join(clients.select("customer_id"), "customer_id", "left_semi")
    brands = _products(tables).select("product_id", "brand")
    sold = (
        tables.order_items.select("order_id", "product_id")
        .join(wanted.select("order_id"), "order_id", "left_semi")
        .join(brands, "product_id")
        .select("brand", "order_id")
    )
    # Every brand once more without an order: keeps the zeros, adds nothing to a count.
    every_brand = brands.select("brand", F.lit(None).cast("bigint").alias("order_id"))
    return (
        sold.unionAll(every_brand)
        .groupBy("brand")
        .agg(F.countDistinct("order_id").alias("online_orders_count"))
        .orderBy(*descending("online_orders_count"), *ascending("brand"))
    )


def customer_spend_grouped(tables: ShopTables) -> DataFrame:
    """Sum, largest, smallest and average line amount, and distinct orders per customer."""
    spend = spend_by_customer(tables.customer, _list_price_spend(tables), NAMES)
    return spend.select(
        "customer_id",
        *NAMES,
        as_double(F.col("amount_sum")).alias("total_revenue"),
        F.col("amount_max").alias("max_order"),
        F.col("amount_min").alias("min_order"),
        F.col("order_count").alias("orders_count"),
        _average(F.col("amount_sum"), F.col("amount_count")).alias("avg_order"),
    ).orderBy(*descending("total_revenue", "orders_count"), *ascending("customer_id"))


def customer_spend_windowed(tables: ShopTables) -> DataFrame:
    """The same profile by windows over the customer; here ``orders_count`` counts lines.

    The windows run over lines already summed per customer, so a window holds one row per
    spelling of the customer's name instead of all the customer's lines.
    """
    spend = spend_by_customer(tables.customer, _list_price_spend(tables), NAMES)
    customer = Window.partitionBy("customer_id")
    total = F.sum("amount_sum").over(customer)
    return (
        spend.select(
            "customer_id",
            *NAMES,
            as_double(total).alias("total_revenue"),
            F.max("amount_max").over(customer).alias("max_order"),
            F.min("amount_min").over(customer).alias("min_order"),
            F.sum("line_count").over(customer).alias("orders_count"),
            _average(total, F.sum("amount_count").over(customer)).alias("avg_order"),
        )
        .distinct()
        .orderBy(*descending("total_revenue", "orders_count"), *ascending("customer_id", *NAMES))
    )


def lowest_spenders(tables: ShopTables, n: int = 3) -> DataFrame:
    """The ``n`` customers with the least list-price spend; no orders counts as 0."""
    return _spend_ranked(tables, ascending("total_amount", "customer_id"), n)


def highest_spenders(tables: ShopTables, n: int = 3) -> DataFrame:
    """The ``n`` customers with the most list-price spend."""
    order = [*descending("total_amount"), *ascending("customer_id")]
    return _spend_ranked(tables, order, n)


def second_order(tables: ShopTables, n: int = 2) -> DataFrame:
    """Every customer's ``n``-th order by date and its list-price amount.

    Orders without lines are not counted.
    """
    amounts = (
        tables.orders.select("customer_id", "order_id", "order_date")
        .filter(F.col("customer_id").isNotNull())
        .join(_list_price_totals(tables), "order_id")
        .groupBy("customer_id", "order_id", "order_date")
        .agg(F.sum("amount_sum").alias("amount"))
    )
    chosen = nth_per_group(amounts, ["customer_id"], ascending("order_date", "order_id"), n)
    keys = ["customer_id", *NAMES, "order_id", "order_date"]
    return (
        tables.customer.select("customer_id", *NAMES)
        .join(chosen, "customer_id")
        .groupBy(keys)
        .agg(as_double(F.sum("amount")).alias("transaction_amount"))
    )


def longest_order_gap(tables: ShopTables) -> DataFrame:
    """Longest gap in days between consecutive orders, for customers with at least two gaps."""
    keys = ["customer_id", *NAMES, "job_title"]
    return (
        tables.customer.select(keys)
        .join(longest_gaps(tables.orders), "customer_id")
        .groupBy(keys)
        .agg(
            F.max("longest_gap").alias("max_interval_days"),
            F.sum("order_count").alias("order_count"),
        )
        .filter(F.col("order_count") - 1 > 1)
        .drop("order_count")
        .orderBy(*descending("max_interval_days"), *ascending("customer_id"))
    )


def segment_top5_list_price(tables: ShopTables, n: int = 5) -> DataFrame:
    """The ``n`` names with most list-price revenue per wealth segment, numbered.

    Namesakes within a segment are one name. A name whose every price is missing has no
    revenue figure and ranks first.
    """
    keys = [*NAMES, "wealth_segment"]
    revenue = (
        tables.customer.select("customer_id", *keys)
        .join(_list_price_spend(tables), "customer_id")
        .groupBy(keys)
        .agg(F.sum("amount_sum").alias("total_revenue"))
    )
    order = [*descending("total_revenue"), *ascending(*NAMES)]
    return (
        top_n_per_group(revenue, ["wealth_segment"], order, n, "rank_in_segment")
        .withColumn("total_revenue", as_double(F.col("total_revenue")))
        .orderBy(*ascending("wealth_segment", "rank_in_segment"))
    )


def sale_spend(tables: ShopTables) -> DataFrame:
    """Every customer with segment and total amount at sale prices; 0 without orders."""
    per_customer = customer_totals(tables.orders, order_totals(tables.order_items, SALE_PRICE))
    spend = spend_by_customer(
        tables.customer, per_customer, [*NAMES, "wealth_segment"], how="left"
    )
    return spend.select(
        "customer_id", *NAMES, "wealth_segment", or_zero(F.col("amount_sum")).alias("total")
    )


def spend_extremes(tables: ShopTables, n: int = 3) -> DataFrame:
    """The ``n`` lowest and ``n`` highest spenders at sale prices, labelled, highest first."""
    return spend_extremes_of(sale_spend(tables), n)


def spend_extremes_of(spend: DataFrame, n: int = 3) -> DataFrame:
    """``spend_extremes`` from a finished ``sale_spend`` table."""
    ends = both_ends(
        spend.select("customer_id", *NAMES, "total"),
        low=ascending("total", "customer_id"),
        high=[*descending("total"), *ascending("customer_id")],
        n=n,
        low_label=f"TOP-{n} MIN",
        high_label=f"TOP-{n} MAX",
        into="category",
    )
    return ends.orderBy(*descending("total"), *ascending("customer_id")).select(
        *NAMES, as_double(F.col("total")).alias("total_amount"), "category"
    )


def segment_top5_sale_price(tables: ShopTables, n: int = 5) -> DataFrame:
    """The ``n`` customers with most revenue at sale prices per wealth segment."""
    return segment_top5_of(sale_spend(tables), n)


def segment_top5_of(spend: DataFrame, n: int = 5) -> DataFrame:
    """``segment_top5_sale_price`` from a finished ``sale_spend`` table."""
    order = [*descending("total"), *ascending("customer_id")]
    return (
        top_n_per_group(spend, ["wealth_segment"], order, n)
        .orderBy(*ascending("wealth_segment", "rank"))
        .select(*NAMES, "wealth_segment", as_double(F.col("total")).alias("total_revenue"))
    )


def _products(tables: ShopTables) -> DataFrame:
    if tables.product_cor is None:
        raise ValueError("this report needs the corrected product list (product_cor)")
    return tables.product_cor


def _list_price_totals(tables: ShopTables) -> DataFrame:
    return order_totals(tables.order_items, LIST_PRICE, _products(tables))


def _list_price_spend(tables: ShopTables) -> DataFrame:
    return customer_totals(tables.orders, _list_price_totals(tables))


def _spend_ranked(tables: ShopTables, order, n: int) -> DataFrame:
    spend = spend_by_customer(tables.customer, _list_price_spend(tables), NAMES, how="left")
    totals = spend.select(
        "customer_id", *NAMES, or_zero(F.col("amount_sum")).alias("total_amount")
    )
    return first_n(totals, order, n).withColumn("total_amount", as_double(F.col("total_amount")))


def _average(total, count):
    """Null when there is nothing to average."""
    return F.when(count > 0, as_double(total) / count)
