"""Loading files, storing tables, writing and reading reports."""

from __future__ import annotations

from decimal import Decimal
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions.dates import as_day
from orderlens.plans import reports
from orderlens.sources import (
    load_csv,
    name_tables,
    open_table,
    open_tables,
    read_report,
    report_folder,
    save_product_cor,
    save_report,
    save_table,
    versions,
)
from orderlens.sources.csv_files import MISSING
from orderlens.tables import CUSTOMER, ORDER_ITEMS, ORDERS, PRODUCT

SMALL = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("price", T.DecimalType(12, 2)),
    T.StructField("flag", T.BooleanType()),
    T.StructField("name", T.StringType()),
])


def write(path, text: str) -> str:
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_customer_file_uses_semicolons_and_keeps_undeclared_columns(spark, tmp_path, rows):
    path = write(
        tmp_path / "customer.csv",
        "customer_id;first_name;last_name;job_title;job_industry_category;wealth_segment;DOB\n"
        "1;Zoë;O'Neil;;n/a;Mass Customer;1990-01-01\n"
        '2.0;"A;B";"say ""hi""";NA;IT;High Net Worth;\n',
    )
    loaded = load_csv(spark, path, CUSTOMER, sep=";")
    assert loaded.dtypes == [
        ("customer_id", "bigint"), ("first_name", "string"), ("last_name", "string"),
        ("job_title", "string"), ("job_industry_category", "string"),
        ("wealth_segment", "string"), ("DOB", "string"),
    ]
    assert rows(loaded) == [
        (1, "Zoë", "O'Neil", None, None, "Mass Customer", "1990-01-01"),
        (2, "A;B", 'say "hi"', None, "IT", "High Net Worth", None),
    ]


def test_declared_types_are_applied(spark, tmp_path, rows):
    path = write(
        tmp_path / "items.csv",
        "order_id,product_id,quantity,item_list_price_at_sale\n1,2,3,71.49\n1.0,,1.50,1e3\n",
    )
    loaded = load_csv(spark, path, ORDER_ITEMS)
    assert loaded.schema.simpleString() == ORDER_ITEMS.simpleString()
    assert rows(loaded) == [
        (1, 2, Decimal("3.00"), Decimal("71.49")),
        (1, None, Decimal("1.50"), Decimal("1000.00")),
    ]
    path = write(
        tmp_path / "orders.csv",
        "order_id,customer_id,order_date,order_status,online_order\n"
        "1,7,2017-02-25,Approved,True\n2,,2017-02-26,Cancelled,\n",
    )
    assert rows(load_csv(spark, path, ORDERS)) == [
        (1, 7, "2017-02-25", "Approved", True), (2, None, "2017-02-26", "Cancelled", None),
    ]


def test_every_exact_spelling_of_a_number_is_accepted(spark, tmp_path, rows):
    path = write(
        tmp_path / "numbers.csv",
        "id,price,flag,name\n-1,.5,TRUE,a\n+2,-1.50,false,b\n 3 ,1.000,True,c\n"
        "4e2,1.5e1,True,d\n9223372036854775807,9999999999.99,True,e\n",
    )
    assert [row[:2] for row in rows(load_csv(spark, path, SMALL))] == [
        (-1, Decimal("0.50")), (2, Decimal("-1.50")), (3, Decimal("1.00")),
        (400, Decimal("15.00")), (9223372036854775807, Decimal("9999999999.99")),
    ]


def test_missing_values_are_the_same_as_in_pandas(spark, tmp_path, rows):
    words = [*MISSING, "na", "Null", "none", "N.A.", "-", " NA", "0", "NaN ", '""']
    path = write(
        tmp_path / "words.csv", "id,name\n" + "".join(f"{i},{w}\n" for i, w in enumerate(words))
    )
    schema = T.StructType([SMALL["id"], SMALL["name"]])
    ours = [name for _, name in sorted(rows(load_csv(spark, path, schema)))]
    theirs = [None if pd.isna(name) else name for name in pd.read_csv(path)["name"]]
    assert ours == theirs


@pytest.mark.parametrize(
    "line", ["x,1,True,a", "1.5,1,True,a", "1,1.234,True,a", "1,12345678901.00,True,a",
             "1,1,maybe,a", "1,one,True,a", "1,.,True,a", "1,1e-9,True,a", "1,1.5.0,True,a",
             "9223372036854775808,1,True,a", "1e30,1,True,a"],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_text_stops_the_load(spark, settings, tmp_path, line, ansi):
    settings(spark__sql__ansi__enabled=ansi)
    path = write(tmp_path / "bad.csv", f"id,price,flag,name\n1,1,True,ok\n{line}\n")
    with pytest.raises(Exception, match="column (id|price|flag): '"):
        load_csv(spark, path, SMALL).collect()


@pytest.mark.parametrize("line", ["1,1,True", "1,1,True,a,extra", '1,1,True,"two\nlines"'])
def test_rows_of_the_wrong_length_stop_the_load(spark, tmp_path, line):
    path = write(tmp_path / "ragged.csv", f"id,price,flag,name\n1,1,True,ok\n{line}\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|[Mm]alformed"):
        load_csv(spark, path, SMALL).collect()


def test_line_breaks_inside_quotes_load_on_request(spark, tmp_path, rows):
    path = write(tmp_path / "lines.csv", 'id,price,flag,name\n1,1,True,"two\nlines"\n')
    assert rows(load_csv(spark, path, SMALL, multi_line=True)) == [
        (1, Decimal("1.00"), True, "two\nlines")
    ]


def test_missing_columns_are_named_unless_the_columns_are_open(spark, tmp_path):
    path = write(tmp_path / "product.csv", "product_id,colour\n1,red\n")
    with pytest.raises(ValueError, match="brand, list_price"):
        load_csv(spark, path, PRODUCT)
    assert load_csv(spark, path, PRODUCT, require_all=False).dtypes == [
        ("product_id", "bigint"), ("colour", "string")
    ]


def test_a_directory_of_files_is_one_table_and_headers_must_agree(spark, tmp_path):
    parts = tmp_path / "parts"
    parts.mkdir()
    write(parts / "a.csv", "id,price,flag,name\n1,1,True,a\n")
    write(parts / "b.csv", "id,price,flag,name\n2,2,False,b\n")
    assert load_csv(spark, str(parts), SMALL).count() == 2
    write(parts / "c.csv", "price,id,flag,name\n3,3,False,c\n")
    with pytest.raises(Exception, match="header"):
        load_csv(spark, str(parts), SMALL).collect()


def test_saving_replaces_the_table_and_counts_its_rows(spark, shop, tmp_path, rows):
    first = shop(product=[(1, "A", 1), (2, "B", None), (3, None, 2)])
    path = str(tmp_path / "product")
    assert save_table(first.product_cor, path) == 3
    assert save_table(shop(product=[(9, "Z", 4)]).product_cor, path) == 1
    assert rows(open_table(spark, path)) == [(9, "Z", Decimal("4.00"))]
    assert save_table(shop().product_cor, path) == 0


def test_stored_tables_open_by_name(spark, shop, tmp_path):
    tables = shop(product=[(1, "A", 1)])
    for name in ("customer", "orders", "order_items"):
        save_table(getattr(tables, name), str(tmp_path / name))
    save_table(tables.product_cor.unionAll(tables.product_cor), str(tmp_path / "product"))
    opened = open_tables(spark, str(tmp_path))
    assert opened.product_cor is None and opened.customer.schema == tables.customer.schema
    with pytest.raises(ValueError, match="corrected product list"):
        reports.online_orders_by_brand(opened)
    save_product_cor(tables.product_cor, str(tmp_path))
    assert open_tables(spark, str(tmp_path), product_cor="product_cor").product_cor.count() == 1


def test_a_repeated_product_is_never_stored_as_corrected(spark, shop, tmp_path, rows):
    good = shop(product=[(1, "A", 1), (2, "B", 2), (None, "C", 3), (None, "C", 3)]).product_cor
    assert save_product_cor(good.withColumn("colour", F.lit("red")), str(tmp_path)) == 4
    twice = shop(product=[(7, "A", 1), (7, "B", 2), (8, "A", 1), (9, None, None), (9, None, None)]).product_cor
    with pytest.raises(ValueError, match=r"\(product_id\) is not unique: \(7,\) in 2 rows; \(9,\) in 2 rows"):
        save_product_cor(twice, str(tmp_path))
    kept = open_table(spark, str(tmp_path / "product_cor"))
    assert kept.columns == PRODUCT.names and {r[0] for r in rows(kept)} == {1, 2, None}
    assert len(list((tmp_path / "product_cor").glob("v*"))) == 1


def test_a_constraint_may_span_columns(spark, shop, tmp_path):
    items = shop(items=[(1, 1, 1, 1), (1, 2, 1, 1), (2, 1, 1, 1)]).order_items
    assert save_table(items, str(tmp_path / "t"), unique=("order_id", "product_id")) == 3
    with pytest.raises(ValueError, match="order_id"):
        save_table(items, str(tmp_path / "t"), unique=("order_id",))


def test_old_versions_go_after_the_switch(spark, shop, tmp_path, rows):
    path = str(tmp_path / "product")
    reader = None
    for k in range(5):
        save_table(shop(product=[(k, "A", 1)]).product_cor, path)
        if reader is not None:  # opened before this load, still readable after it
            assert rows(reader)[0][0] == k - 1
        reader = open_table(spark, path)
    assert len(versions(spark, path)) == 2 and len(list((tmp_path / "product").glob("v*"))) == 2
    save_table(shop(product=[(9, "A", 1)]).product_cor, path, keep=1)
    assert len(list((tmp_path / "product").glob("v*"))) == 1 and rows(open_table(spark, path))[0][0] == 9
    with pytest.raises(ValueError, match="at least one"):
        save_table(shop().product_cor, path, keep=0)


def test_named_tables_answer_sql(spark, shop, rows):
    name_tables(shop(orders=[(1, 7, "2020-01-01", "Approved", True)], items=[(1, 2, 3, 4)]))
    question = "SELECT o.customer_id, i.quantity FROM orders o JOIN order_items i USING (order_id)"
    assert rows(spark.sql(question)) == [(7, Decimal("3.00"))]


def test_reports_round_trip_in_order_with_plain_numbers_and_empty_nulls(spark, tmp_path, rows):
    schema = "name STRING, segment STRING, total DOUBLE"
    data = [("b", None, 12345678.9), ('say "x", y', "s", 0.0), (None, "two\nlines", 2.5)]
    report = spark.createDataFrame(data, schema).coalesce(1)
    path = tmp_path / "report"
    save_report(report, str(path))
    files = list(Path(report_folder(spark, str(path))).glob("part-*.csv"))
    assert len(files) == 1
    assert files[0].read_text().splitlines()[:2] == ["name,segment,total", "b,,12345678.9"]
    assert rows(read_report(spark, str(path), report.schema)) == data
    as_pandas = pd.read_csv(files[0])
    assert list(as_pandas["total"]) == [12345678.9, 0.0, 2.5]
    assert as_pandas["name"][1] == 'say "x", y'


def test_an_ordered_small_report_becomes_one_file(spark, tmp_path):
    report = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count().orderBy("k")
    save_report(report, str(tmp_path / "report"))
    files = list(Path(report_folder(spark, str(tmp_path / "report"))).glob("part-*.csv"))
    assert len(files) == 1
    assert [line.split(",")[0] for line in files[0].read_text().splitlines()[1:]] == list("0123456")


def test_failed_load_leaves_the_table(spark, shop, rows, tmp_path):
    path = str(tmp_path / "product")
    save_table(shop(product=[(1, "Z", 4)]).product_cor, path)
    bad = spark.range(3).selectExpr("if(id = 2, raise_error('bad row'), id) AS product_id")
    with pytest.raises(Exception, match="bad row"):
        save_table(bad, path)
    assert [r[0] for r in rows(open_table(spark, path))] == [1]


def test_doubles_keep_all_digits(spark, rows, tmp_path):
    numbers = [16 / 3, 12345678.9, 1e300, 1e-9, -0.1, 0.0, 136632.46000000002, float("inf"), None]
    frame = spark.createDataFrame([(x,) for x in numbers], "x double")
    save_report(frame, str(tmp_path / "r"))
    back = [r[0] for r in rows(read_report(spark, str(tmp_path / "r"), frame.schema))]
    assert sorted(map(str, back)) == sorted(map(str, numbers))
    assert any("12345678.9\n" in f.read_text() for f in (tmp_path / "r").glob("v*/*.csv"))


@pytest.mark.parametrize(
    "schema,data",
    [
        ("x double", [(None,), (1.5,), (None,), (None,)]),
        ("x long", [(None,), (None,)]),
        ("x boolean", [(True,), (None,)]),
        ("x string", [(None,), ("a",), ("null",), ("NULL",), ('""',), ('"',), (" ",), (None,)]),
        ("x date", [(None,)]),
        ("x decimal(12,2)", [(None,), (Decimal("1.50"),)]),
        ("x string, y string", [(" a ", "\tb"), (None, None), (" ", None)]),
        ("x string, y double", [(None, None), ("a", None), (None, 1.0), (None, None)]),
    ],
)
def test_rows_of_nulls_only_come_back(spark, rows, tmp_path, schema, data):
    save_report(spark.createDataFrame(data, schema).coalesce(1), str(tmp_path / "r"))
    back = read_report(spark, str(tmp_path / "r"), spark.createDataFrame([], schema).schema)
    assert rows(back) == data


def test_an_empty_text_is_a_missing_one(spark, rows, tmp_path):
    save_report(spark.createDataFrame([("",), ("a",)], "x string").coalesce(1), str(tmp_path / "r"))
    assert rows(read_report(spark, str(tmp_path / "r"), spark.createDataFrame([], "x string").schema)) == [(None,), ("a",)]


def test_a_failed_report_leaves_the_old_one(spark, rows, tmp_path):
    path = str(tmp_path / "r")
    save_report(spark.range(3), path)
    bad = spark.range(5).selectExpr("if(id = 4, raise_error('no report'), id) AS id")
    with pytest.raises(Exception, match="no report"):
        save_report(bad, path)
    assert sorted(rows(read_report(spark, path, spark.range(1).schema))) == [(0,), (1,), (2,)]
    assert len(list((tmp_path / "r").glob("v*"))) == 1
    save_report(spark.range(1), path)
    assert rows(read_report(spark, path, spark.range(1).schema)) == [(0,)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_dates_fail_in_both_modes(spark, settings, rows, ansi):
    settings(spark__sql__ansi__enabled=ansi)
    good = spark.createDataFrame([("2020-01-31",), (None,)], "d string").select(as_day("d"))
    assert [str(r[0]) for r in rows(good)] == ["2020-01-31", "None"]
    with pytest.raises(Exception, match="not a date"):
        spark.createDataFrame([("2020-13-45",)], "d string").select(as_day("d")).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("text", ["2020", "2020-01", "2020-01-31 07:00", "2020-01-31T07:00:00", "2020-01-32", "", "31.01.2020", "12020-01-31", "-2020-01-31"])
def test_only_full_dates_are_dates(spark, settings, text, ansi):
    settings(spark__sql__ansi__enabled=ansi)
    with pytest.raises(Exception, match="not a date"):
        spark.createDataFrame([(text,)], "d string").select(as_day("d")).collect()


@pytest.mark.parametrize("text", ["2020-02-29", "2020-2-29", " 2020-02-29 "])
def test_spellings_of_a_full_date(spark, rows, text):
    assert str(rows(spark.createDataFrame([(text,)], "d string").select(as_day("d")))[0][0]) == "2020-02-29"
