"""The reports against literal SQL on random tables with nulls, ties and repeated rows."""

from __future__ import annotations

import random

import duckdb
import pytest

from orderlens.driver_oracle import report_body
from orderlens.driver_queries import REPORTS

NAMES = ["Ann", "Bob", None]
INDUSTRIES = ["BUILDING", "Retail", None]
SEGMENTS = ["Mass Customer", "High Net Worth", None]
DAYS = ["2020-01-01", "2020-01-02", "2020-02-29", "2021-12-31", None]

VIEWS = {
    "shop_customer": "customer", "shop_orders": "orders", "shop_items": "order_items",
    "shop_product": "product_cor",
}


def random_shop(shop, seed: int):
    rnd = random.Random(seed)
    pick = rnd.choice
    hot = rnd.random() < 0.5  # one customer, order and product with a large share of rows

    def key(n):
        return 1 if hot and rnd.random() < 0.4 else rnd.randint(1, n)

    customer = [
        (k, pick(NAMES), pick(NAMES), pick(["Clerk", None]), pick(INDUSTRIES), pick(SEGMENTS))
        for k in range(1, 16)
    ]
    orders = [
        (k, pick([key(18), key(18), key(18), None]), pick(DAYS), pick(["F", "O", None]),
         pick([True, False, None]))
        for k in range(1, 61)
    ]
    items = [
        (key(65), key(12), pick([1, 2, 0.5, None]), pick([10, 20.25, None]))
        for _ in range(150)
    ]
    product = [(k, pick(["A", "B", "C", None]), pick([5, 7.5, None])) for k in range(1, 11)]
    if seed % 2:  # repeated rows multiply amounts, in SQL as here
        customer += customer[:2]
        orders += orders[:5]
        product += product[:2]
    return shop(customer, orders, items, product)


@pytest.mark.parametrize("seed", range(6))
def test_reports_equal_literal_sql(shop, seed):
    tables = random_shop(shop, seed)
    con = duckdb.connect()
    for view, table in VIEWS.items():
        con.register(view, getattr(tables, table).toArrow())
    for name, report in REPORTS.items():
        frame = report(tables)
        answer = con.execute(report_body(name))
        order = [column[0] for column in answer.description]
        wanted = sorted(map(repr, answer.fetchall()))
        got = sorted(repr(tuple(row[column] for column in order)) for row in frame.collect())
        assert got == wanted, (name, seed)
