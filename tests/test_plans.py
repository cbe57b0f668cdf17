"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from orderlens.driver_queries import REPORTS
from orderlens.driver_tables import shop_tables
from orderlens.plans import reports
from orderlens.tables import ShopTables

DATA = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan_of(frame) -> str:
    frame.collect()
    return plan_of(frame).split("== Initial Plan ==")[0]


@pytest.fixture
def big_tables(settings):
    """Plans as for tables too large to broadcast."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )


@pytest.mark.parametrize("name", REPORTS)
def test_no_report_gathers_a_table_or_leaves_the_jvm(spark, big_tables, name):
    plan = plan_of(REPORTS[name](shop_tables(spark, DATA)))
    for bad in ("SinglePartition", "CartesianProduct", "NestedLoop", "Python", "Pandas", "Arrow"):
        assert bad not in plan, bad


@pytest.mark.parametrize("name", REPORTS)
def test_lines_are_shuffled_once_per_key(spark, big_tables, name):
    """One scan of the lines, and at most product, order and customer shuffles after it."""
    plan = final_plan_of(REPORTS[name](shop_tables(spark, DATA)))
    scans = len(re.findall(r"FileScan parquet \[l_orderkey", plan))
    assert scans == (0 if name in ("clients_by_industry", "longest_order_gap") else 1)


def test_sums_are_combined_before_every_shuffle(spark, big_tables):
    plan = plan_of(reports.segment_top5_sale_price(shop_tables(spark, DATA))).splitlines()
    for key in ("order_id", "customer_id"):
        final = next(i for i, line in enumerate(plan) if re.search(rf"keys=\[{key}#\d+L\]", line))
        assert "Exchange hashpartitioning" in plan[final + 1]
        assert "partial_sum" in plan[final + 2]


@pytest.mark.parametrize(
    "name", ["segment_top5_list_price", "segment_top5_sale_price", "second_order"]
)
def test_rank_limits_apply_before_the_shuffle(spark, big_tables, name):
    plan = plan_of(REPORTS[name](shop_tables(spark, DATA)))
    assert len(re.findall(r"WindowGroupLimit .*Partial", plan)) == 1
    assert len(re.findall(r"WindowGroupLimit .*Final", plan)) == 1


@pytest.mark.parametrize("name", ["lowest_spenders", "highest_spenders"])
def test_the_first_few_are_kept_by_bounded_heaps(spark, big_tables, name):
    assert "TakeOrderedAndProject(limit=3" in plan_of(REPORTS[name](shop_tables(spark, DATA)))


def test_both_ends_share_one_computation_of_the_totals(spark, big_tables):
    plan = final_plan_of(reports.spend_extremes(shop_tables(spark, DATA)))
    assert plan.count("TakeOrderedAndProject") == 2
    assert plan.count("ReusedExchange") == 2
    assert "Window" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = reports.monthly_revenue_by_industry(shop_tables(spark, DATA), "F")
    text = plan._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "EqualTo(o_orderstatus,F)" in text
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>", text)
    assert "p_brand" not in text and "o_orderpriority" not in text


def test_hot_products_orders_and_customers_are_split(spark, settings, big_tables, tmp_path, rows):
    """A third of all lines on one product and on one order, of all orders on one customer."""
    settings(
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="40KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="8",
    )
    orders = spark.range(0, 30000, 1, 8).selectExpr(
        "id AS order_id", "IF(id % 3 = 0, 1, id % 500) AS customer_id",
        "'2020-01-01' AS order_date", "'Approved' AS order_status", "true AS online_order",
    )
    items = spark.range(0, 90000, 1, 8).selectExpr(
        "IF(hash(id) % 3 = 0, 7, id % 30000) AS order_id",
        "IF(id % 3 = 0, 1, id % 800) AS product_id",
        "CAST(1 + hash(id) % 1000000 / 1e6 AS DECIMAL(12,2)) AS quantity",
        "CAST(1 AS DECIMAL(12,2)) AS item_list_price_at_sale",
    )
    customer = spark.range(500).selectExpr(
        "id AS customer_id", "'a' AS first_name", "'b' AS last_name", "'c' AS job_title",
        "'IT' AS job_industry_category", "'Mass Customer' AS wealth_segment",
    )
    product = spark.range(800).selectExpr(
        "id AS product_id", "'A' AS brand", "CAST(1 AS DECIMAL(12,2)) AS list_price"
    )
    stored = {}
    for name, frame in {
        "customer": customer, "orders": orders, "order_items": items, "product_cor": product,
    }.items():
        frame.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    report = reports.monthly_revenue_by_industry(ShopTables(**stored))
    plan = final_plan_of(report)
    for key in ("product_id", "order_id", "customer_id"):
        assert re.search(rf"SortMergeJoin\(skew=true\) \[{key}", plan), key
    total = stored["order_items"].selectExpr("CAST(SUM(quantity) AS DOUBLE) AS t").first().t
    assert rows(report) == [(2020, 1, "IT", total)]
