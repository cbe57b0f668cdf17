"""The result gate and the daily run."""

from __future__ import annotations

from pathlib import Path
from unittest.mock import Mock

import pytest

from orderlens.driver_tables import export_csv, shop_tables, table_named
from orderlens.job import INPUTS, load_input, load_tables, main, run_job, with_line_breaks, write_reports
from orderlens.plans import reports
from orderlens.quality import EmptyReports, failures, report_counts, require_non_empty
from orderlens.sources import read_report, save_report
from orderlens.workspace import application_directory, clear_work, new_directory, stored

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def saved(spark, tmp_path):
    """Paths and schemas of a full, an empty and an absent report."""
    full = spark.range(3).selectExpr("CAST(id AS STRING) AS name", "CAST(id AS DOUBLE) AS total")
    save_report(full, str(tmp_path / "full"))
    save_report(full.limit(0), str(tmp_path / "empty"))
    return {name: (str(tmp_path / name), full.schema) for name in ("full", "empty", "absent")}


def test_gate_counts_rows_and_treats_an_absent_report_as_empty(spark, saved):
    counts = report_counts(spark, saved)
    assert counts.dtypes == [
        ("report", "string"), ("row_count", "bigint"), ("passed", "boolean")
    ]
    assert sorted(map(tuple, counts.collect())) == [
        ("absent", 0, False), ("empty", 0, False), ("full", 3, True),
    ]


def test_gate_names_every_failed_report(spark, saved):
    with pytest.raises(EmptyReports, match="^reports with 0 rows: empty, absent$") as raised:
        require_non_empty(report_counts(spark, saved))
    assert raised.value.failed == [("empty", 0), ("absent", 0)]
    assert sorted(map(tuple, failures(report_counts(spark, saved)).collect())) == [("absent", 0), ("empty", 0)]
    require_non_empty(report_counts(spark, {"full": saved["full"]}))


def test_gate_does_not_hide_other_read_problems(spark, saved):
    path, _ = saved["full"]
    wrong = spark.range(1).selectExpr("id AS a", "id AS b").schema
    with pytest.raises(Exception, match="header"):
        report_counts(spark, {"bad": (path, wrong)}).collect()


def test_run_writes_both_reports_from_files(spark, tmp_path, rows):
    tables = shop_tables(spark, DATA)
    for name in INPUTS:
        export_csv(tables, str(tmp_path / "in"), name)
    counts = run_job(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert sorted(map(tuple, counts.collect())) == [
        ("segment_top5_sale_price", 15, True), ("spend_extremes", 6, True),
    ]
    for name in ("spend_extremes", "segment_top5_sale_price"):
        direct = getattr(reports, name)(tables)
        written = read_report(spark, str(tmp_path / "out" / name), direct.schema)
        assert rows(written) == rows(direct), name


def test_run_fails_when_the_reports_are_empty(spark, tmp_path):
    tables = shop_tables(spark, DATA)
    for name in INPUTS:
        frame = table_named(tables, name).limit(0)
        frame.write.csv(str(tmp_path / "in" / f"{name}.csv"), sep=INPUTS[name].sep, header=True)
    with pytest.raises(ValueError, match="spend_extremes, segment_top5_sale_price"):
        run_job(spark, str(tmp_path / "in"), str(tmp_path / "out"))


def test_a_second_run_replaces_the_first(spark, tmp_path):
    tables = shop_tables(spark, DATA)
    for name in INPUTS:
        export_csv(tables, str(tmp_path / "in"), name)
    out = str(tmp_path / "out")
    first = load_tables(spark, str(tmp_path / "in"), f"{out}/tables")
    assert load_tables(spark, str(tmp_path / "in"), f"{out}/tables") == first
    assert first == {name: table_named(tables, name).count() for name in INPUTS}
    for _ in range(2):
        assert {row.row_count for row in write_reports(spark, f"{out}/tables", out).collect()} == {6, 15}


def test_top_spenders_reappear_among_the_best_of_their_segment(spark, rows):
    tables = shop_tables(spark, DATA)
    best = {row[3] for row in rows(reports.segment_top5_sale_price(tables))}
    top = [row[2] for row in rows(reports.spend_extremes(tables)) if row[3] == "TOP-3 MAX"]
    assert len(top) == 3 and set(top) <= best


@pytest.fixture
def broken_lines(spark, tmp_path):
    """Input files of the smallest data, one customer's name running over two lines."""
    tables = shop_tables(spark, DATA)
    for name in INPUTS:
        export_csv(tables, str(tmp_path / "in"), name)
    part = tmp_path / "in" / "customer.csv" / "part-extra.csv"
    part.write_text(
        "customer_id;first_name;last_name;job_title;job_industry_category;wealth_segment\n"
        '999999;"Ann\nMarie";"said ""hi"";";Clerk;IT;Mass Customer\n'
    )
    return tmp_path


def test_the_run_takes_line_breaks_inside_quotes_where_told(spark, broken_lines, rows):
    source, out = str(broken_lines / "in"), str(broken_lines / "out")
    with pytest.raises(Exception, match="MALFORMED|[Mm]alformed"):
        run_job(spark, source, out)
    inputs = with_line_breaks(["customer"])
    assert run_job(spark, source, out, inputs).count() == 2
    ann = load_input(spark, source, "customer", inputs).filter("customer_id = 999999")
    assert rows(ann) == [(999999, "Ann\nMarie", 'said "hi";', "Clerk", "IT", "Mass Customer")]
    spend = spark.read.parquet(str(broken_lines / "out" / "tables" / "customer_spend" / "v*"))
    assert spend.filter("customer_id = 999999").count() == 1
    with pytest.raises(ValueError, match="no such input: clients"):
        with_line_breaks(["clients"])


def test_the_command_line_passes_the_options_on(spark, broken_lines):
    main([str(broken_lines / "in"), str(broken_lines / "out"), "--multi-line", "customer"])
    assert report_counts(spark, {"x": (str(broken_lines / "out" / "spend_extremes"), reports.spend_extremes(shop_tables(spark, DATA)).schema)}).first().row_count == 6
    with pytest.raises(SystemExit):
        main([str(broken_lines / "in")])


def test_work_directories_follow_the_session():
    def session(**conf):
        return Mock(conf={k.replace("__", "."): v for k, v in conf.items()})

    shared = session(spark__checkpoint__dir="hdfs://shared/work/", spark__sql__warehouse__dir="hdfs://house")
    one, two = new_directory(shared, "x"), new_directory(shared, "x")
    assert one != two and one.startswith("hdfs://shared/work/orderlens/")
    assert new_directory(session(spark__sql__warehouse__dir="hdfs://house"), "x").startswith("hdfs://house/orderlens/")


def test_what_was_stored_on_the_way_can_be_cleared(spark):
    folder = Path(application_directory(spark).removeprefix("file:"))
    assert stored(spark.range(3), "numbers").count() == 3 and list(folder.glob("numbers-*"))
    clear_work(spark)
    assert not folder.exists()
    clear_work(spark)
