"""Each report on hand-made rows that hold the awkward cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderlens.operators import numbered
from orderlens.plans import reports


def client(key, first="Ann", last="Lee", title="Clerk", industry="IT", segment="Mass Customer"):
    return key, first, last, title, industry, segment


def order(key, customer, day="2020-01-01", status="Approved", online=True):
    return key, customer, day, status, online


def test_clients_by_industry_counts_missing_as_one_group_and_sorts_it_last_in_ties(shop, rows):
    tables = shop(customer=[
        client(1, industry="IT"), client(2, industry="IT"),
        client(3, industry=None), client(4, industry="Retail"),
    ])
    assert rows(reports.clients_by_industry(tables)) == [("IT", 2), ("Retail", 1), (None, 1)]


def test_monthly_revenue_takes_approved_orders_at_list_price(shop, rows):
    tables = shop(
        customer=[client(1), client(2, industry=None)],
        orders=[
            order(10, 1, "2020-02-29"), order(11, 1, "2020-02-01"), order(12, 2, "2019-12-31"),
            order(13, 1, "2020-02-02", status="Cancelled"), order(14, 1, status=None),
        ],
        items=[(10, 1, 2, 99), (11, 1, 1, 99), (12, 2, 3, 99), (13, 1, 50, 99), (14, 1, 50, 99)],
        product=[(1, "A", 1.25), (2, "B", None)],
    )
    assert rows(reports.monthly_revenue_by_industry(tables)) == [
        (2019, 12, None, None), (2020, 2, "IT", 3.75),
    ]


def test_online_orders_keep_brands_without_sales_and_ignore_industry(shop, rows):
    tables = shop(
        customer=[client(1, industry="IT"), client(2, industry="Retail")],
        orders=[
            order(10, 1), order(11, 2), order(12, 1, online=False), order(13, 1, online=None),
            order(14, 1, status="Cancelled"), order(15, None),
        ],
        items=[
            (10, 1, 1, 1), (10, 1, 1, 1), (10, 2, 1, 1), (11, 1, 1, 1), (12, 1, 1, 1),
            (13, 1, 1, 1), (14, 1, 1, 1), (15, 3, 1, 1), (10, 99, 1, 1),
        ],
        product=[(1, "A", 1), (2, "A", 1), (3, None, 1), (4, "Z", 1), (5, None, 1)],
    )
    assert rows(reports.online_orders_by_brand(tables)) == [("A", 2), (None, 1), ("Z", 0)]
    assert rows(reports.online_orders_by_brand(tables, only_industry="IT")) == [
        ("A", 1), ("Z", 0), (None, 0),
    ]


def test_spend_profiles_differ_only_in_the_order_count(shop, rows):
    tables = shop(
        customer=[client(1, last=None), client(2), client(3)],
        orders=[order(10, 1), order(11, 1), order(12, 2), order(13, 3)],
        items=[(10, 1, 2, 9), (10, 2, 1, 9), (11, 1, 1, 9), (12, 3, 7, 9), (11, 99, 1, 9)],
        product=[(1, "A", 10), (2, "A", 0.5), (3, "B", None)],
    )
    # Customer 2 has only an unpriced line: no sum sorts first when descending.
    assert rows(reports.customer_spend_grouped(tables)) == [
        (2, "Ann", "Lee", None, None, None, 1, None),
        (1, "Ann", None, 30.5, 20.0, 0.5, 2, 30.5 / 3),
    ]
    assert rows(reports.customer_spend_windowed(tables)) == [
        (2, "Ann", "Lee", None, None, None, 1, None),
        (1, "Ann", None, 30.5, 20.0, 0.5, 3, 30.5 / 3),
    ]


def test_spenders_count_missing_spend_as_zero_and_settle_ties_by_id(shop, rows):
    tables = shop(
        customer=[client(k) for k in (5, 4, 3, 2, 1)],
        orders=[order(10, 1), order(11, 2), order(12, 3), order(13, 4)],
        items=[(10, 1, 1, 1), (11, 1, 3, 1), (12, 2, 1, 1), (13, 99, 1, 1)],
        product=[(1, "A", 10), (2, "A", None)],
    )
    low = [(k, amount) for k, _, _, amount in rows(reports.lowest_spenders(tables))]
    high = [(k, amount) for k, _, _, amount in rows(reports.highest_spenders(tables))]
    assert low == [(3, 0.0), (4, 0.0), (5, 0.0)]
    assert high == [(2, 30.0), (1, 10.0), (3, 0.0)]


def test_second_order_skips_orders_without_lines_and_breaks_day_ties_by_id(shop, rows):
    tables = shop(
        customer=[client(1), client(2), client(3)],
        orders=[
            order(12, 1, "2020-01-05"), order(11, 1, "2020-01-05"), order(10, 1, "2020-01-01"),
            order(20, 2, "2020-01-01"), order(21, 2, "2020-01-02"), order(22, 2, "2020-01-03"),
            order(30, 3), order(40, None, "2019-01-01"), order(41, None, "2019-01-02"),
        ],
        items=[(k, 1, 1, 1) for k in (10, 11, 12, 20, 22, 30, 40, 41)] + [(22, 1, 4, 1)],
        product=[(1, "A", 10)],
    )
    assert sorted(rows(reports.second_order(tables))) == [
        (1, "Ann", "Lee", 11, "2020-01-05", 10.0),
        (2, "Ann", "Lee", 22, "2020-01-03", 50.0),
    ]


def test_longest_gap_needs_three_orders_and_counts_orders_without_lines(shop, rows):
    tables = shop(
        customer=[client(k) for k in (1, 2, 3, 4, 5)],
        orders=[
            order(10, 1, "2020-01-01"), order(11, 1, "2020-01-01"), order(12, 1, "2020-03-01"),
            order(20, 2, "2020-01-01"), order(21, 2, "2021-01-01"),
            order(30, 3), order(31, 3), order(32, 3),
            order(40, 4, "2020-01-01"), order(41, 4, None), order(42, 4, "2020-01-09"),
            order(50, 5, "2020-01-01"), order(51, 5, "2020-03-01"), order(52, 5, "2020-03-02"),
        ],
    )
    assert [(row[0], row[4]) for row in rows(reports.longest_order_gap(tables))] == [
        (1, 60), (5, 60), (3, 0),
    ]


def test_list_price_segments_merge_namesakes_and_rank_missing_revenue_first(shop, rows):
    tables = shop(
        customer=[
            client(1, "Ann"), client(2, "Ann"), client(3, "Bob"), client(4, "Cid"),
            client(5, "Dan", segment=None), client(6, "Eve"),
        ],
        orders=[order(10 + k, k) for k in range(1, 6)],
        items=[(11, 1, 1, 1), (12, 1, 2, 1), (13, 1, 2, 1), (14, 2, 9, 1), (15, 1, 1, 1)],
        product=[(1, "A", 10), (2, "A", None)],
    )
    assert rows(reports.segment_top5_list_price(tables, n=2)) == [
        ("Cid", "Lee", "Mass Customer", None, 1),
        ("Ann", "Lee", "Mass Customer", 30.0, 2),
        ("Dan", "Lee", None, 10.0, 1),
    ]


def test_sale_price_segments_keep_namesakes_apart_and_show_zero_spenders(shop, rows):
    tables = shop(
        customer=[client(2), client(1), client(3, "Bob", None, segment="Affluent Customer")],
        orders=[order(10, 1), order(11, 2)],
        items=[(10, 1, 2, 5), (11, 99, 3, 5), (11, 99, 3, None)],
    )
    assert rows(reports.segment_top5_sale_price(tables)) == [
        ("Bob", None, "Affluent Customer", 0.0),
        ("Ann", "Lee", "Mass Customer", 15.0),
        ("Ann", "Lee", "Mass Customer", 10.0),
    ]


def test_extremes_list_highest_first_with_three_of_each(shop, rows):
    tables = shop(
        customer=[client(k, f"C{k}") for k in range(1, 9)],
        orders=[order(10 + k, k) for k in range(1, 7)],
        items=[(10 + k, 1, k, 10) for k in range(1, 7)],
    )
    assert [(row[0], row[2], row[3]) for row in rows(reports.spend_extremes(tables))] == [
        ("C6", 60.0, "TOP-3 MAX"), ("C5", 50.0, "TOP-3 MAX"), ("C4", 40.0, "TOP-3 MAX"),
        ("C1", 10.0, "TOP-3 MIN"), ("C7", 0.0, "TOP-3 MIN"), ("C8", 0.0, "TOP-3 MIN"),
    ]


def test_extremes_of_four_customers_list_nobody_twice(shop, rows):
    tables = shop(
        customer=[client(k, f"C{k}") for k in range(1, 5)],
        orders=[order(10 + k, k) for k in range(1, 5)],
        items=[(10 + k, 1, k, 10) for k in range(1, 5)],
    )
    assert [(row[0], row[3]) for row in rows(reports.spend_extremes(tables))] == [
        ("C4", "TOP-3 MAX"), ("C3", "TOP-3 MIN"), ("C2", "TOP-3 MIN"), ("C1", "TOP-3 MIN"),
    ]


def test_reports_over_empty_tables_are_empty(shop, rows):
    tables = shop()
    for name in (
        "clients_by_industry", "monthly_revenue_by_industry", "online_orders_by_brand",
        "customer_spend_grouped", "customer_spend_windowed", "lowest_spenders",
        "highest_spenders", "second_order", "longest_order_gap", "segment_top5_list_price",
        "spend_extremes", "segment_top5_sale_price",
    ):
        assert rows(getattr(reports, name)(tables)) == [], name


def test_totals_stay_exact_beyond_double_precision(shop, rows):
    lines = [(10, 1, 1, 0.01)] * 3 + [(10, 1, 1, 9999999999.99)] * 2
    tables = shop(customer=[client(1)], orders=[order(10, 1)], items=lines)
    assert rows(reports.segment_top5_sale_price(tables))[0][3] == 20000000000.01


def test_a_malformed_date_stops_the_report(shop):
    tables = shop(
        customer=[client(1)], orders=[order(10, 1, "2020-13-45")], items=[(10, 1, 1, 1)],
        product=[(1, "A", 1)],
    )
    for report in (reports.longest_order_gap, reports.monthly_revenue_by_industry):
        with pytest.raises(Exception, match="2020-13-45"):
            report(tables).collect()


def test_rows_are_numbered_in_their_order_across_partitions(spark, settings, rows):
    settings(spark__sql__shuffle__partitions="7", spark__sql__adaptive__enabled="false")
    frame = spark.range(1000).selectExpr("(id * 37) % 1000 AS k", "id % 3 AS _part").orderBy(F.desc("k"))
    got = numbered(frame)
    assert got.columns == ["k", "_part", "position"] and got.count() == 1000
    assert all(position == 1000 - k for k, _, position in rows(got))
    assert numbered(frame.limit(0)).count() == 0
