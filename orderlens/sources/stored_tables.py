"""The loaded tables as Parquet, replaced in full at every load."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import fields

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderlens.sources.versions import KEPT, current_folder, replace_content
from orderlens.tables import PRODUCT, ShopTables

#: Keys named when a constraint fails.
NAMED = 5


def save_table(rows: DataFrame, path: str, unique: Sequence[str] = (), keep: int = KEPT) -> int:
    """Replace the table at ``path``; returns its row count, taken while writing.

    A failed load leaves the table as it was. With ``unique``, no two rows may agree in these
    columns (rows with a null in them agree with none); the written rows are checked before they
    become the table, and a repeated key raises ``ValueError``. The last ``keep`` versions stay, for
    readers that still use an older one.
    """
    spark = rows.sparkSession
    written = Observation("written")

    def write(folder: str) -> None:
        rows.observe(written, F.count(F.lit(1)).alias("rows")).write.parquet(folder)

    def check(folder: str) -> None:
        require_unique(spark.read.schema(rows.schema).parquet(folder), unique, path)

    replace_content(spark, path, write, check if unique else None, keep)
    return written.get["rows"]


def require_unique(rows: DataFrame, columns: Sequence[str], name: str) -> None:
    """Raise ``ValueError`` with some of the keys that more than one row has."""
    repeated = (
        rows.select(*columns).dropna().groupBy(*columns).agg(F.count(F.lit(1)).alias("times"))
        .filter(F.col("times") > 1).orderBy(*columns).limit(NAMED).collect()
    )
    if repeated:
        found = "; ".join(f"{tuple(row)[:-1]} in {row.times} rows" for row in repeated)
        raise ValueError(f"{name}: ({', '.join(columns)}) is not unique: {found}")


def save_product_cor(products: DataFrame, directory: str, keep: int = KEPT) -> int:
    """Store the corrected product list beside the other tables.

    Every order line is priced through this list, so that a second row of a product would count
    the product's revenue twice: one row per ``product_id``, or nothing is stored.
    """
    return save_table(products.select(PRODUCT.names), f"{directory}/product_cor", ("product_id",), keep)


def open_table(spark: SparkSession, path: str) -> DataFrame:
    """The version of the table at ``path`` that was saved last."""
    return spark.read.parquet(current_folder(spark, path))


def open_tables(spark: SparkSession, directory: str, product_cor: str | None = None) -> ShopTables:
    """The tables saved under ``directory``, one subdirectory per table.

    ``product_cor`` names the subdirectory of the corrected product list, for the reports that price
    by list or ask for brands. The product table as loaded never takes its place by itself.
    """
    names = ("customer", "orders", "order_items")
    found = {name: open_table(spark, f"{directory}/{name}") for name in names}
    if product_cor is not None:
        found["product_cor"] = open_table(spark, f"{directory}/{product_cor}")
    return ShopTables(**found)


def name_tables(tables: ShopTables) -> None:
    """Make the tables readable by name in ``spark.sql``."""
    for field in fields(tables):
        table = getattr(tables, field.name)
        if table is not None:
            table.createOrReplaceTempView(field.name)
