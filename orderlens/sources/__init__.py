"""Files and tables in, tables and reports out."""

from orderlens.sources.csv_files import load_csv
from orderlens.sources.report_files import read_report, report_folder, save_report
from orderlens.sources.stored_tables import (
    name_tables,
    open_table,
    open_tables,
    require_unique,
    save_product_cor,
    save_table,
)
from orderlens.sources.versions import versions

__all__ = [
    "load_csv", "name_tables", "open_table", "open_tables", "read_report", "report_folder",
    "require_unique", "save_product_cor", "save_report", "save_table", "versions",
]
