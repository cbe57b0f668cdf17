"""The driver's test tables seen as the four logical tables.

The same expressions are written in SQL in ``driver_oracle.py``; keep the two in step.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.job import INPUTS
from orderlens.sources.csv_files import MISSING
from orderlens.tables import MONEY, ShopTables

STATUS = "F"  # stands for 'Approved'
INDUSTRY = "BUILDING"  # stands for 'IT'
BUYERS = 10
_MONEY = MONEY.simpleString()

# The columns in use, declared so that opening a table reads no file.
_COLUMNS = {
    "customer": "c_custkey BIGINT, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_quantity DOUBLE, l_extendedprice DOUBLE",
    "part": "p_partkey BIGINT, p_brand STRING, p_retailprice DOUBLE",
}


def shop_tables(spark: SparkSession, sf_dir: str) -> ShopTables:
    def table(name: str) -> DataFrame:
        return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")

    return ShopTables(
        customer=table("customer")
        .join(table("nation").withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")
        .selectExpr(
            "c_custkey AS customer_id",
            "n_name AS first_name",
            "c_mktsegment AS last_name",
            "n_name AS job_title",
            "c_mktsegment AS job_industry_category",
            "CASE WHEN c_acctbal < 3000 THEN 'Mass Customer'"
            " WHEN c_acctbal < 6000 THEN 'Affluent Customer'"
            " ELSE 'High Net Worth' END AS wealth_segment",
        ),
        orders=table("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "CAST(CAST(o_orderdate AS DATE) AS STRING) AS order_date",
            "o_orderstatus AS order_status",
            "o_orderpriority IN ('1-URGENT', '2-HIGH') AS online_order",
        ),
        order_items=table("lineitem").selectExpr(
            "l_orderkey AS order_id",
            "l_partkey AS product_id",
            f"CAST(l_quantity AS {_MONEY}) AS quantity",
            f"CAST(l_extendedprice AS {_MONEY}) AS item_list_price_at_sale",
        ),
        product_cor=table("part").selectExpr(
            "p_partkey AS product_id",
            "p_brand AS brand",
            f"CAST(p_retailprice AS {_MONEY}) AS list_price",
        ),
    )


def table_named(tables: ShopTables, name: str) -> DataFrame:
    """The rows that stand for the input file of that name."""
    return tables.product_cor if name == "product" else getattr(tables, name)


def export_csv(tables: ShopTables, directory: str, name: str) -> None:
    """Write one table the way the job expects its input file."""
    _write_csv(table_named(tables, name), directory, name)


def export_messy_csv(tables: ShopTables, directory: str, name: str) -> None:
    """Write one table with the spellings real files have: every word for a missing value, whole
    numbers with decimals, flags in any case, and a column nobody declared."""
    text = table_named(tables, name).select([F.col(c).cast("string") for c in table_named(tables, name).columns])
    _write_csv(text.selectExpr(*_MESSY[name]), directory, name)


def _write_csv(rows: DataFrame, directory: str, name: str) -> None:
    rows.write.csv(f"{directory}/{name}.csv", sep=INPUTS[name].sep, header=True, quote='"', escape='"')


def _blanked(column: str, key: str, every: int, otherwise: str | None = None) -> str:
    """A word for a missing value in every so many rows, another word each time."""
    words = ", ".join(f"'{word}'" for word in MISSING)
    number = f"CAST({key} AS BIGINT)"
    word = f"element_at(array({words}), CAST({number} % {len(MISSING)} AS INT) + 1)"
    return f"CASE WHEN {number} % {every} = 0 THEN {word} ELSE {otherwise or column} END AS {column}"


_MESSY = {
    "customer": (
        "customer_id || element_at(array('', '.0', '.00'), CAST(customer_id % 3 AS INT) + 1) AS customer_id",
        _blanked("first_name", "customer_id", 13),
        _blanked("last_name", "customer_id", 3),
        _blanked("job_title", "customer_id", 5),
        _blanked("job_industry_category", "customer_id", 7),
        _blanked("wealth_segment", "customer_id", 11),
        _blanked("notes", "customer_id", 2, "'said \"no; \" ' || customer_id"),
    ),
    "product": (
        "product_id || element_at(array('', '.0'), CAST(product_id % 2 AS INT) + 1) AS product_id",
        _blanked("brand", "product_id", 6),
        _blanked("list_price", "product_id", 5),
    ),
    "orders": (
        "order_id || element_at(array('.0', '', '.000'), CAST(order_id % 3 AS INT) + 1) AS order_id",
        _blanked("customer_id", "order_id", 10, "customer_id || '.0'"),
        _blanked("order_date", "order_id", 8),
        _blanked("order_status", "order_id", 9),
        _blanked(
            "online_order", "order_id", 6,
            "CASE order_id % 4 WHEN 1 THEN initcap(online_order) WHEN 2 THEN upper(online_order) ELSE online_order END",
        ),
    ),
    "order_items": (
        "order_id || element_at(array('.0', ''), CAST(product_id % 2 AS INT) + 1) AS order_id",
        _blanked("product_id", "order_id", 13),
        _blanked("quantity", "product_id", 10, "CASE product_id % 3 WHEN 1 THEN CAST(CAST(quantity AS DOUBLE) AS INT) || '' WHEN 2 THEN quantity || '0' ELSE quantity END"),
        _blanked("item_list_price_at_sale", "order_id", 17),
    ),
}


def idle(tables: ShopTables) -> ShopTables:
    """All rows, most customers without orders: only ids divisible by ``BUYERS`` stay on orders."""
    buyer = F.col("customer_id")
    return replace(tables, orders=tables.orders.withColumn("customer_id", _blank(buyer, buyer % BUYERS != 0)))


def with_gaps(tables: ShopTables) -> ShopTables:
    """All rows, with nulls where real files have them: names, keys, dates, flags, prices."""
    last_name, industry = F.col("last_name"), F.col("job_industry_category")
    segment, online = F.col("wealth_segment"), F.col("online_order")
    brand, price = F.col("brand"), F.col("list_price")
    return replace(
        tables,
        customer=tables.customer.withColumns({
            "last_name": _blank(last_name, last_name == "MACHINERY"),
            "job_industry_category": _blank(industry, industry == "FURNITURE"),
            "wealth_segment": _blank(segment, segment == "Affluent Customer"),
        }),
        orders=tables.orders.withColumns({
            "customer_id": _blank(F.col("customer_id"), F.col("order_status") == "P"),
            "order_date": _blank(F.col("order_date"), online),
            "online_order": _blank(online, ~online),
        }),
        product_cor=tables.product_cor.withColumns({
            "brand": _blank(brand, brand == "Brand#1"),
            "list_price": _blank(price, price < 950),
        }),
    )


def _blank(value: Column, condition: Column) -> Column:
    return F.when(~condition, value)
