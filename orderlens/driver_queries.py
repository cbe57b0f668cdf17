"""Every report and job step as a query over the driver's test tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import driver_oracle
from orderlens.driver_oracle import ORDERS, SAVED
from orderlens.driver_tables import (
    INDUSTRY,
    STATUS,
    export_csv,
    export_messy_csv,
    idle,
    shop_tables,
    table_named,
    with_gaps,
)
from orderlens.job import INPUTS, load_input, load_tables, run_job, write_reports
from orderlens.operators import numbered
from orderlens.plans import reports
from orderlens.quality import EmptyReports, report_counts, require_non_empty
from orderlens.sources import (
    open_table,
    open_tables,
    read_report,
    save_product_cor,
    save_report,
    save_table,
)
from orderlens.tables import ShopTables
from orderlens.workspace import new_directory

# Also run with few buyers, when most customers have no order or no priced line.
SPARSE = ("lowest_spenders", "spend_extremes", "segment_top5_list_price", "segment_top5_sale_price")

Report = Callable[[ShopTables], DataFrame]
Query = Callable[[SparkSession, str], DataFrame]

REPORTS: dict[str, Report] = {
    "clients_by_industry": reports.clients_by_industry,
    "monthly_revenue_by_industry": lambda t: reports.monthly_revenue_by_industry(t, STATUS),
    "online_orders_by_brand": lambda t: reports.online_orders_by_brand(t, STATUS),
    "online_orders_by_brand_one_industry": lambda t: reports.online_orders_by_brand(
        t, STATUS, only_industry=INDUSTRY
    ),
    "customer_spend_grouped": reports.customer_spend_grouped,
    "customer_spend_windowed": reports.customer_spend_windowed,
    "lowest_spenders": reports.lowest_spenders,
    "highest_spenders": reports.highest_spenders,
    "second_order": reports.second_order,
    "longest_order_gap": reports.longest_order_gap,
    "segment_top5_list_price": reports.segment_top5_list_price,
    "spend_extremes": reports.spend_extremes,
    "segment_top5_sale_price": reports.segment_top5_sale_price,
}


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for name, report in REPORTS.items():
        found[name] = _over_tables(report)
        found[f"{name}_gaps"] = _over_tables(report, gaps=True)
    for name in SPARSE:
        found[f"{name}_idle_gaps"] = _over_tables(REPORTS[name], few_buyers=True, gaps=True)
    for name in ORDERS:
        found[f"{name}_ordered"] = _ordered(name)
    for name in INPUTS:
        found[f"load_{name}"] = _loaded(name, export_csv)
        found[f"load_{name}_gaps"] = _loaded(name, export_messy_csv)
        found[f"stored_{name}"] = _stored(name)
    found["stored_product_cor"] = stored_product_cor
    for name in (*SAVED, "customer_spend_grouped"):
        found[f"saved_{name}"] = _saved(name)
    found["table_row_counts"] = table_row_counts
    found["result_gate"] = result_gate
    found["result_gate_states"] = result_gate_states
    found["result_gate_failure"] = result_gate_failure
    found["run_job"] = whole_job
    for name in SAVED:
        found[f"run_job_{name}"] = _written_by_job(name)
    return found


def oracle_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for name in REPORTS:
        found[name] = driver_oracle.report_sql(name)
        found[f"{name}_gaps"] = driver_oracle.report_sql(name, gaps=True)
    for name in SPARSE:
        found[f"{name}_idle_gaps"] = driver_oracle.report_sql(name, idle=True, gaps=True)
    for name in ORDERS:
        found[f"{name}_ordered"] = driver_oracle.ordered_sql(name)
    for name in INPUTS:
        found[f"load_{name}"] = driver_oracle.table_sql(name)
        found[f"load_{name}_gaps"] = driver_oracle.messy_table_sql(name)
        found[f"stored_{name}"] = driver_oracle.table_sql(name)
    found["stored_product_cor"] = driver_oracle.report_sql("online_orders_by_brand")
    for name in (*SAVED, "customer_spend_grouped"):
        found[f"saved_{name}"] = driver_oracle.report_sql(name)
    found["table_row_counts"] = driver_oracle.row_counts_sql()
    found["result_gate"] = driver_oracle.gate_sql()
    found["result_gate_states"] = driver_oracle.gate_states_sql()
    found["result_gate_failure"] = driver_oracle.gate_states_sql(only_failed=True)
    found["run_job"] = driver_oracle.gate_sql()
    for name in SAVED:
        found[f"run_job_{name}"] = driver_oracle.report_sql(name)
    return found


def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each table as counted while loading it from its exported file."""
    work = _exported(spark, sf_dir, export_csv, *INPUTS)
    counts = load_tables(spark, work, f"{work}/tables")
    return spark.createDataFrame(list(counts.items()), "table_name STRING, row_count BIGINT")


def stored_product_cor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per brand over stored tables, the corrected product list stored under its constraint.

    A product table with repeated ids lies beside it and must neither be stored as the corrected list
    nor take part in the report.
    """
    work, tables = new_directory(spark, "corrected"), shop_tables(spark, sf_dir)
    for name in INPUTS:
        save_table(table_named(tables, name), f"{work}/{name}")
    save_product_cor(tables.product_cor, work)
    twice = tables.product_cor.unionAll(tables.product_cor)
    save_table(twice, f"{work}/product")
    try:
        save_product_cor(twice, work)
    except ValueError:
        return REPORTS["online_orders_by_brand"](open_tables(spark, work, product_cor="product_cor"))
    raise AssertionError("a product list with repeated ids was stored")


def result_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of both saved reports."""
    work = new_directory(spark, "gate")
    tables = shop_tables(spark, sf_dir)
    for name in INPUTS:
        save_table(table_named(tables, name), f"{work}/tables/{name}")
    return write_reports(spark, f"{work}/tables", work)


def result_gate_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of a full report, one without rows and one never written."""
    work = new_directory(spark, "gate")
    report = REPORTS[SAVED[1]](shop_tables(spark, sf_dir))
    save_report(report, f"{work}/full")
    save_report(report.filter(F.col("total_revenue") < 0), f"{work}/empty")
    return report_counts(spark, {name: (f"{work}/{name}", report.schema) for name in ("full", "empty", "absent")})


def result_gate_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate raises about the same three."""
    try:
        require_non_empty(result_gate_states(spark, sf_dir))
    except EmptyReports as error:
        return spark.createDataFrame(error.failed, "report STRING, row_count BIGINT")
    raise AssertionError("the gate let empty reports pass")


def whole_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily run over exported files."""
    work = _exported(spark, sf_dir, export_csv, *INPUTS)
    return run_job(spark, work, f"{work}/out")


def _written_by_job(name: str) -> Query:
    """One report as the daily run leaves it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        work = _exported(spark, sf_dir, export_csv, *INPUTS)
        run_job(spark, work, f"{work}/out")
        return read_report(spark, f"{work}/out/{name}", REPORTS[name](shop_tables(spark, sf_dir)).schema)

    return run


def _loaded(name: str, export: Callable[[ShopTables, str, str], None]) -> Query:
    """One table, exported to its file and loaded back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(load_input(spark, _exported(spark, sf_dir, export, name), name))

    return run


def _stored(name: str) -> Query:
    """One table, loaded from its file and stored in place of older content."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        work = _exported(spark, sf_dir, export_csv, name)
        loaded = load_input(spark, work, name)
        for rows in (loaded.unionAll(loaded), loaded.limit(0), loaded):
            save_table(rows, f"{work}/table", keep=1)
        return _plain(open_table(spark, f"{work}/table"))

    return run


def _saved(name: str) -> Query:
    """One report, written as a file and read back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        report = REPORTS[name](shop_tables(spark, sf_dir))
        path = f"{new_directory(spark, 'report')}/{name}"
        save_report(report, path)
        return read_report(spark, path, report.schema)

    return run


def _ordered(name: str) -> Query:
    """One report over tables with gaps, its rows numbered as they come."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return numbered(REPORTS[name](with_gaps(shop_tables(spark, sf_dir))))

    return run


def _plain(rows: DataFrame) -> DataFrame:
    return rows.select([
        F.col(field.name).cast("double").alias(field.name) if isinstance(field.dataType, T.DecimalType) else F.col(field.name)
        for field in rows.schema
    ])


def _exported(
    spark: SparkSession, sf_dir: str, export: Callable[[ShopTables, str, str], None], *names: str
) -> str:
    work = new_directory(spark, "files")
    for name in names:
        export(shop_tables(spark, sf_dir), work, name)
    return work


def _over_tables(report: Report, few_buyers: bool = False, gaps: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = shop_tables(spark, sf_dir)
        if few_buyers:
            tables = idle(tables)
        if gaps:
            tables = with_gaps(tables)
        return report(tables)

    return run
