"""The reports as SQL over the driver's test tables, for comparison by value.

Each statement answers its question from what is asked, not from the DataFrame code: lines are priced
once, set against orders by membership or key, and ranked by ordered lists or limits.
"""

from __future__ import annotations

from orderlens.driver_tables import BUYERS, INDUSTRY, STATUS
from orderlens.sources.csv_files import MISSING

_CUSTOMER = """
    SELECT c_custkey AS customer_id, n_name AS first_name, c_mktsegment AS last_name,
           n_name AS job_title, c_mktsegment AS job_industry_category,
           CASE WHEN c_acctbal < 3000 THEN 'Mass Customer'
                WHEN c_acctbal < 6000 THEN 'Affluent Customer'
                ELSE 'High Net Worth' END AS wealth_segment
    FROM customer JOIN nation ON c_nationkey = n_nationkey"""

_ORDERS = """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
           o_orderstatus AS order_status,
           o_orderpriority IN ('1-URGENT', '2-HIGH') AS online_order
    FROM orders"""

_ITEMS = """
    SELECT l_orderkey AS order_id, l_partkey AS product_id,
           CAST(l_quantity AS DECIMAL(12,2)) AS quantity,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS item_list_price_at_sale
    FROM lineitem"""

_PRODUCT = """
    SELECT p_partkey AS product_id, p_brand AS brand,
           CAST(p_retailprice AS DECIMAL(12,2)) AS list_price
    FROM part"""

_GAPS_CUSTOMER = f"""
    SELECT customer_id, first_name, NULLIF(last_name, 'MACHINERY') AS last_name, job_title,
           NULLIF(job_industry_category, 'FURNITURE') AS job_industry_category,
           NULLIF(wealth_segment, 'Affluent Customer') AS wealth_segment
    FROM ({_CUSTOMER}) full_customer"""

_GAPS_ORDERS = """
    SELECT order_id, CASE WHEN order_status <> 'P' THEN customer_id END AS customer_id,
           CASE WHEN NOT online_order THEN order_date END AS order_date, order_status,
           NULLIF(online_order, FALSE) AS online_order
    FROM ({orders}) full_orders"""

_GAPS_PRODUCT = f"""
    SELECT product_id, NULLIF(brand, 'Brand#1') AS brand,
           CASE WHEN list_price >= 950 THEN list_price END AS list_price
    FROM ({_PRODUCT}) full_product"""


def _shop(idle: bool = False, gaps: bool = False) -> str:
    orders = _ORDERS
    if idle:
        orders = (
            f"SELECT * REPLACE (CASE WHEN customer_id % {BUYERS} = 0 THEN customer_id END AS customer_id)"
            f" FROM ({orders}) all_orders"
        )
    customer, product = _CUSTOMER, _PRODUCT
    if gaps:
        orders = _GAPS_ORDERS.format(orders=orders)
        customer, product = _GAPS_CUSTOMER, _GAPS_PRODUCT
    return (
        f"shop_customer AS ({customer}),\nshop_orders AS ({orders}),\n"
        f"shop_items AS ({_ITEMS}),\nshop_product AS ({product})"
    )


# Every line with a known product, at its list price, under the customer who ordered it.
_LISTED = """listed AS (
    SELECT customer_id, order_id, order_date, order_status, quantity * list_price AS amount
    FROM shop_items JOIN shop_product USING (product_id) JOIN shop_orders USING (order_id))"""

# What each customer paid at the prices of the day; nothing is 0.
_PAID = """paid AS (
    SELECT customer_id, first_name, last_name, wealth_segment, COALESCE(SUM(amount), 0) AS total
    FROM shop_customer LEFT JOIN (
        SELECT customer_id, quantity * item_list_price_at_sale AS amount
        FROM shop_items JOIN shop_orders USING (order_id)) sold USING (customer_id)
    GROUP BY ALL)"""

_CLIENTS = """
SELECT job_industry_category, COUNT(*) AS client_count FROM shop_customer GROUP BY ALL"""

_MONTHLY = f"""
WITH {_LISTED},
dated AS (SELECT customer_id, amount, CAST(order_date AS DATE) AS day
          FROM listed WHERE order_status = '{STATUS}')
SELECT CAST(DATE_PART('year', day) AS INTEGER) AS year, CAST(DATE_PART('month', day) AS INTEGER) AS month,
       job_industry_category, CAST(SUM(amount) AS DOUBLE) AS total_revenue
FROM dated JOIN shop_customer USING (customer_id) GROUP BY ALL"""

_ONLINE = f"""
WITH wanted AS (SELECT order_id FROM shop_orders WHERE online_order AND order_status = '{STATUS}' {{more}}),
sold AS (SELECT brand, order_id FROM shop_product JOIN shop_items USING (product_id)
         WHERE order_id IN (FROM wanted)
         UNION SELECT brand, NULL FROM shop_product)
SELECT brand, COUNT(order_id) AS online_orders_count FROM sold GROUP BY brand"""

_OF_INDUSTRY = f"""AND customer_id IN (
    SELECT customer_id FROM shop_customer WHERE job_industry_category = '{INDUSTRY}')"""

_SPEND = f"""
WITH {_LISTED}
SELECT customer_id, first_name, last_name, {{orders}} AS orders_count,
       CAST(SUM(amount) AS DOUBLE) AS total_revenue,
       MAX(CAST(amount AS DOUBLE)) AS max_order, MIN(CAST(amount AS DOUBLE)) AS min_order,
       CASE WHEN COUNT(amount) > 0 THEN CAST(SUM(amount) AS DOUBLE) / COUNT(amount) END AS avg_order
FROM listed JOIN shop_customer USING (customer_id) GROUP BY ALL"""

_SPENDERS = f"""
WITH {_LISTED},
totals AS (SELECT customer_id, first_name, last_name, COALESCE(SUM(amount), 0) AS total
           FROM shop_customer LEFT JOIN listed USING (customer_id) GROUP BY ALL)
SELECT customer_id, first_name, last_name, CAST(total AS DOUBLE) AS total_amount
FROM totals ORDER BY total {{direction}}, customer_id LIMIT 3"""

_SECOND = f"""
WITH {_LISTED},
bought AS (
    SELECT customer_id, order_id, order_date, SUM(amount) AS amount FROM listed
    WHERE customer_id IS NOT NULL GROUP BY ALL),
seconds AS (
    SELECT customer_id, LIST(bought ORDER BY order_date NULLS LAST, order_id)[2] AS pick
    FROM bought GROUP BY customer_id HAVING COUNT(*) > 1)
SELECT customer_id, first_name, last_name, pick.order_id, pick.order_date,
       CAST(SUM(pick.amount) AS DOUBLE) AS transaction_amount
FROM seconds JOIN shop_customer USING (customer_id) GROUP BY ALL"""

_GAP = """
WITH days AS (
    SELECT customer_id, CAST(order_date AS DATE) AS day, COUNT(*) AS orders
    FROM shop_orders WHERE order_date IS NOT NULL GROUP BY ALL),
waits AS (
    SELECT customer_id, orders, COALESCE((
        SELECT MIN(later.day) FROM days later
        WHERE later.customer_id = days.customer_id AND later.day > days.day) - day, 0) AS wait
    FROM days)
SELECT customer_id, first_name, last_name, job_title, CAST(MAX(wait) AS INTEGER) AS max_interval_days
FROM waits JOIN shop_customer USING (customer_id) GROUP BY ALL HAVING SUM(orders) >= 3"""

_SEGMENT_LIST = f"""
WITH {_LISTED},
named AS (
    SELECT wealth_segment, first_name, last_name, SUM(amount) AS total
    FROM listed JOIN shop_customer USING (customer_id) GROUP BY ALL),
segments AS (
    SELECT wealth_segment, LIST(named ORDER BY total DESC NULLS FIRST, first_name NULLS LAST, last_name NULLS LAST)[:5] AS best
    FROM named GROUP BY wealth_segment),
picks AS (SELECT wealth_segment, UNNEST(best) AS pick, GENERATE_SUBSCRIPTS(best, 1) AS place FROM segments)
SELECT pick.first_name, pick.last_name, wealth_segment, CAST(pick.total AS DOUBLE) AS total_revenue,
       CAST(place AS INTEGER) AS rank_in_segment
FROM picks"""

_EXTREMES = f"""
WITH {_PAID},
lows AS (FROM paid ORDER BY total, customer_id LIMIT 3),
highs AS (FROM paid ORDER BY total DESC, customer_id LIMIT 3),
ends AS (
    SELECT *, 'TOP-3 MIN' AS category FROM lows
    UNION ALL SELECT *, 'TOP-3 MAX' FROM highs WHERE customer_id NOT IN (SELECT customer_id FROM lows))
SELECT first_name, last_name, CAST(total AS DOUBLE) AS total_amount, category FROM ends"""

_SEGMENT_SALE = f"""
WITH {_PAID},
segments AS (
    SELECT wealth_segment, LIST(paid ORDER BY total DESC, customer_id)[:5] AS best
    FROM paid GROUP BY wealth_segment),
picks AS (SELECT wealth_segment, UNNEST(best) AS pick FROM segments)
SELECT pick.first_name, pick.last_name, wealth_segment, CAST(pick.total AS DOUBLE) AS total_revenue
FROM picks"""

_REPORTS = {
    "clients_by_industry": _CLIENTS,
    "monthly_revenue_by_industry": _MONTHLY,
    "online_orders_by_brand": _ONLINE.format(more=""),
    "online_orders_by_brand_one_industry": _ONLINE.format(more=_OF_INDUSTRY),
    "customer_spend_grouped": _SPEND.format(orders="COUNT(DISTINCT order_id)"),
    "customer_spend_windowed": _SPEND.format(orders="COUNT(*)"),
    "lowest_spenders": _SPENDERS.format(direction="ASC"),
    "highest_spenders": _SPENDERS.format(direction="DESC"),
    "second_order": _SECOND,
    "longest_order_gap": _GAP,
    "segment_top5_list_price": _SEGMENT_LIST,
    "spend_extremes": _EXTREMES,
    "segment_top5_sale_price": _SEGMENT_SALE,
}

#: The order a report promises, where its own columns settle it.
ORDERS = {
    "clients_by_industry": "client_count DESC NULLS FIRST, job_industry_category NULLS LAST",
    "monthly_revenue_by_industry": "year NULLS LAST, month NULLS LAST, job_industry_category NULLS LAST",
    "online_orders_by_brand": "online_orders_count DESC NULLS FIRST, brand NULLS LAST",
    "customer_spend_grouped": "total_revenue DESC NULLS FIRST, orders_count DESC NULLS FIRST, customer_id NULLS LAST",
    "longest_order_gap": "max_interval_days DESC NULLS FIRST, customer_id NULLS LAST",
    "segment_top5_list_price": "wealth_segment NULLS LAST, rank_in_segment NULLS LAST",
}

SAVED = ("spend_extremes", "segment_top5_sale_price")


def report_body(report: str) -> str:
    """The query itself, over ``shop_customer``, ``shop_orders``, ``shop_items``, ``shop_product``."""
    return _REPORTS[report]


def report_sql(report: str, idle: bool = False, gaps: bool = False) -> str:
    return f"WITH {_shop(idle, gaps)}\nSELECT * FROM ({_REPORTS[report]}) report"


def ordered_sql(report: str) -> str:
    """The report over tables with gaps, each row with its place in the promised order."""
    return (
        f"WITH {_shop(gaps=True)}\n"
        f"SELECT *, ROW_NUMBER() OVER (ORDER BY {ORDERS[report]}) AS position FROM ({_REPORTS[report]}) report"
    )


_LOADED = {
    "customer": "*",
    "orders": "*",
    "product": "product_id, brand, CAST(list_price AS DOUBLE) AS list_price",
    "order_items": "order_id, product_id, CAST(quantity AS DOUBLE) AS quantity, "
    "CAST(item_list_price_at_sale AS DOUBLE) AS item_list_price_at_sale",
}


def table_sql(name: str) -> str:
    """What a loader must return after a round trip of one test table through CSV."""
    source = name.replace("order_items", "items")
    return f"WITH {_shop()}\nSELECT {_LOADED[name]} FROM shop_{source}"


_WORDS = ", ".join(f"'{word}'" for word in MISSING)


def _spelled(column: str, key: str, every: int, otherwise: str | None = None) -> str:
    """The text that the messy file of a test table holds."""
    return (
        f"IF({key} % {every} = 0, LIST_EXTRACT([{_WORDS}], 1 + {key} % {len(MISSING)}), "
        f"{otherwise or f'CAST({column} AS VARCHAR)'}) AS {column}"
    )


def _ended(column: str, key: str, *ends: str) -> str:
    """A whole number with one of several endings."""
    chosen = ", ".join(f"'{end}'" for end in ends)
    return f"CAST({column} AS VARCHAR) || LIST_EXTRACT([{chosen}], 1 + {key} % {len(ends)}) AS {column}"


_FLAG = "CAST(online_order AS VARCHAR)"
_QUANTITY = "CAST(CAST(quantity AS BIGINT) AS VARCHAR)"
_MESSY = {
    "customer": [
        _ended("customer_id", "customer_id", "", ".0", ".00"),
        _spelled("first_name", "customer_id", 13),
        _spelled("last_name", "customer_id", 3),
        _spelled("job_title", "customer_id", 5),
        _spelled("job_industry_category", "customer_id", 7),
        _spelled("wealth_segment", "customer_id", 11),
        _spelled("notes", "customer_id", 2, "FORMAT('said \"no; \" {}', customer_id)"),
    ],
    "product": [
        _ended("product_id", "product_id", "", ".0"),
        _spelled("brand", "product_id", 6),
        _spelled("list_price", "product_id", 5),
    ],
    "orders": [
        _ended("order_id", "order_id", ".0", "", ".000"),
        _spelled("customer_id", "order_id", 10, "FORMAT('{}.0', customer_id)"),
        _spelled("order_date", "order_id", 8),
        _spelled("order_status", "order_id", 9),
        _spelled(
            "online_order", "order_id", 6,
            f"CASE order_id % 4 WHEN 1 THEN UPPER({_FLAG}[1]) || {_FLAG}[2:] WHEN 2 THEN UPPER({_FLAG}) ELSE {_FLAG} END",
        ),
    ],
    "order_items": [
        _ended("order_id", "product_id", ".0", ""),
        _spelled("product_id", "order_id", 13),
        _spelled(
            "quantity", "product_id", 10,
            f"CASE product_id % 3 WHEN 1 THEN {_QUANTITY} WHEN 2 THEN {_QUANTITY} || '.000' ELSE {_QUANTITY} || '.00' END",
        ),
        _spelled("item_list_price_at_sale", "order_id", 17),
    ],
}

#: How text becomes a value once the words for a missing one are gone.
_VALUES = {
    "customer_id": "CAST(CAST({} AS DECIMAL(38,3)) AS BIGINT)",
    "product_id": "CAST(CAST({} AS DECIMAL(38,3)) AS BIGINT)",
    "order_id": "CAST(CAST({} AS DECIMAL(38,3)) AS BIGINT)",
    "quantity": "CAST(CAST({} AS DECIMAL(12,2)) AS DOUBLE)",
    "list_price": "CAST(CAST({} AS DECIMAL(12,2)) AS DOUBLE)",
    "item_list_price_at_sale": "CAST(CAST({} AS DECIMAL(12,2)) AS DOUBLE)",
    "online_order": "LOWER({}) = 'true'",
}


def messy_table_sql(name: str) -> str:
    """What a loader must return from the messy file of one test table."""
    columns = [text.rsplit(" AS ", 1)[1] for text in _MESSY[name]]
    values = [
        _VALUES.get(c, "{}").format(f"CASE WHEN {c} NOT IN ({_WORDS}) THEN {c} END") + f" AS {c}" for c in columns
    ]
    source = name.replace("order_items", "items")
    return (
        f"WITH {_shop()},\nfile AS (SELECT {', '.join(_MESSY[name])} FROM shop_{source})\n"
        f"SELECT {', '.join(values)} FROM file"
    )


def row_counts_sql() -> str:
    names = {
        "customer": "customer", "product": "product", "orders": "orders", "order_items": "items",
    }
    counts = "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, COUNT(*) AS row_count FROM shop_{source}"
        for table, source in names.items()
    )
    return f"WITH {_shop()}\n{counts}"


def gate_sql() -> str:
    """Counts of both saved reports."""
    return f"WITH {_shop()}\n{_gate({name: _REPORTS[name] for name in SAVED})}"


def gate_states_sql(only_failed: bool = False) -> str:
    """Counts of a full report, one without rows and one never written."""
    counts = _gate({
        "full": _REPORTS[SAVED[1]],
        "empty": f"SELECT * FROM ({_REPORTS[SAVED[1]]}) none WHERE total_revenue < 0",
        "absent": "SELECT 1 WHERE FALSE",
    })
    chosen = "report, row_count FROM states WHERE row_count = 0" if only_failed else "* FROM states"
    return f"WITH {_shop()},\nstates AS ({counts})\nSELECT {chosen}"


def _gate(reports: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS report, COUNT(*) AS row_count, COUNT(*) > 0 AS passed FROM ({body}) saved"
        for name, body in reports.items()
    )
