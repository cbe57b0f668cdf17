"""The daily run: load four files, write two reports, check that neither is empty.

    python -m orderlens.job <input directory> <output directory> [--multi-line <table> ...]
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orderlens.plans import reports
from orderlens.quality import report_counts, require_non_empty
from orderlens.sources import load_csv, open_table, open_tables, save_report, save_table
from orderlens.tables import CUSTOMER, ORDER_ITEMS, ORDERS, PRODUCT

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Input:
    """How one input file is read.

    ``require_all``: every declared column must be present. ``multi_line``: quoted fields may hold
    line breaks; such a file is read by one task, however large, so it has to be asked for.
    """

    schema: T.StructType
    sep: str = ","
    require_all: bool = True
    multi_line: bool = False


INPUTS: Mapping[str, Input] = {
    "customer": Input(CUSTOMER, sep=";"),
    "product": Input(PRODUCT, require_all=False),
    "orders": Input(ORDERS),
    "order_items": Input(ORDER_ITEMS),
}


def with_line_breaks(names: Sequence[str], inputs: Mapping[str, Input] = INPUTS) -> Mapping[str, Input]:
    """The inputs, those named read with line breaks inside quotes."""
    unknown = sorted(set(names) - set(inputs))
    if unknown:
        raise ValueError(f"no such input: {', '.join(unknown)}")
    return {name: replace(file, multi_line=file.multi_line or name in names) for name, file in inputs.items()}


def load_input(
    spark: SparkSession, in_dir: str, name: str, inputs: Mapping[str, Input] = INPUTS
) -> DataFrame:
    """The input file ``<name>.csv`` (or a directory of that name) with its declared types."""
    file = inputs[name]
    return load_csv(spark, f"{in_dir}/{name}.csv", file.schema, file.sep, file.require_all, file.multi_line)


def load_tables(
    spark: SparkSession, in_dir: str, table_dir: str, inputs: Mapping[str, Input] = INPUTS
) -> dict[str, int]:
    """Replace all four tables from their files; returns the row count of each."""
    counts = {}
    for name in inputs:
        counts[name] = save_table(load_input(spark, in_dir, name, inputs), f"{table_dir}/{name}")
        log.info("loaded %d rows into %s", counts[name], name)
    return counts


def write_reports(spark: SparkSession, table_dir: str, out_dir: str) -> DataFrame:
    """Write both reports from the stored tables; returns the gate's counts.

    Both reports rank the same spend per customer, so the lines are read and shuffled
    once: the spend is stored as a table and each report starts from there. A lost
    executor then costs a read of that table, not another pass over the lines.
    """
    spend_path = f"{table_dir}/customer_spend"
    save_table(reports.sale_spend(open_tables(spark, table_dir)), spend_path)
    spend = open_table(spark, spend_path)
    saved = {}
    for name, report in {
        "spend_extremes": reports.spend_extremes_of(spend),
        "segment_top5_sale_price": reports.segment_top5_of(spend),
    }.items():
        save_report(report, f"{out_dir}/{name}")
        saved[name] = (f"{out_dir}/{name}", report.schema)
    return report_counts(spark, saved)


def run_job(
    spark: SparkSession, in_dir: str, out_dir: str, inputs: Mapping[str, Input] = INPUTS
) -> DataFrame:
    """The whole run; raises ``EmptyReports`` if a report came out empty."""
    load_tables(spark, in_dir, f"{out_dir}/tables", inputs)
    counts = write_reports(spark, f"{out_dir}/tables", out_dir)
    require_non_empty(counts)
    return counts


def main(arguments: Sequence[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    parser = argparse.ArgumentParser(prog="python -m orderlens.job", description=__doc__.split("\n")[0])
    parser.add_argument("in_dir", help="folder of the four CSV files")
    parser.add_argument("out_dir", help="folder of the tables and reports")
    parser.add_argument(
        "--multi-line", action="append", default=[], choices=INPUTS, metavar="TABLE",
        help="this file has line breaks inside quotes (repeatable)",
    )
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("sales-and-customers").getOrCreate()
    run_job(spark, given.in_dir, given.out_dir, with_line_breaks(given.multi_line)).show(truncate=False)


if __name__ == "__main__":
    main()
