from __future__ import annotations

import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from orderlens.session import local_session  # noqa: E402
from orderlens.tables import CUSTOMER, ORDER_ITEMS, ORDERS, PRODUCT, ShopTables  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", cores="4", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": tmp_path_factory.mktemp("shared").as_uri(),
    })
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    before = {}

    def change(**values: str) -> None:
        for key, value in values.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def money(value) -> Decimal | None:
    return None if value is None else Decimal(str(value))


@pytest.fixture
def shop(spark):
    """Tables from short tuples; prices and quantities may be plain numbers."""

    def build(customer=(), orders=(), items=(), product=()) -> ShopTables:
        lines = [(o, p, money(q), money(price)) for o, p, q, price in items]
        products = [(p, brand, money(price)) for p, brand, price in product]
        return ShopTables(
            spark.createDataFrame(list(customer), CUSTOMER),
            spark.createDataFrame(list(orders), ORDERS),
            spark.createDataFrame(lines, ORDER_ITEMS),
            spark.createDataFrame(products, PRODUCT),
        )

    return build


@pytest.fixture
def rows():
    """A result as plain tuples in result order."""
    return lambda frame: [tuple(row) for row in frame.collect()]
