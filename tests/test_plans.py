"""The plans of the heavy steps have the shape that the design relies on."""

import re

import pytest

from funnelwright.operators import kpi_fact, tally
from funnelwright.plans import conform_reports
from funnelwright.sources import read_table, write_table
from verification.fixture import raw_reports

SF = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    reports = write_table(conform_reports(raw_reports(spark, SF)), root, "reports")
    contacts = write_table(spark.createDataFrame([("l", "e", "p")], "lead_uuid string, email_hash string, phone_hash string"), root, "contacts")
    return reports, contacts


def test_fact_moves_report_rows_once(stored):
    reports, contacts = stored
    text = plan(kpi_fact(reports, contacts))
    assert len(re.findall(r"FileScan parquet \[entry_date", text)) == 2, "rows to match and rows that cannot match"
    assert text.count("Join ") + text.count("Join[") <= 1
    assert "IsNotNull(email_hash)" in text and "PushedFilters" in text


def test_heavy_keys_add_no_scan_of_the_reports(spark, stored):
    reports, contacts = stored
    heavy = spark.createDataFrame(
        [("e", "p", 4, 3)], "email_hash string, phone_hash string, _left_slices int, _right_slices int"
    )
    text = plan(kpi_fact(reports, contacts, heavy))
    assert len(re.findall(r"FileScan parquet \[entry_date", text)) == 2


def test_tally_reads_only_its_columns(spark, stored, tmp_path):
    reports, contacts = stored
    fact = write_table(kpi_fact(reports, contacts), str(tmp_path), "fact")
    text = plan(tally(read_table(spark, str(tmp_path), "fact"), ["place_uuid"]))
    assert re.search(r"ReadSchema: struct<place_uuid:string,demo:boolean,set:boolean>", text)
    assert "partial_count" in text and text.count("Exchange") == 1
    assert fact.count() > 0


def test_ingest_has_one_shuffle(stored, spark, tmp_path):
    raw = write_table(raw_reports(spark, SF), str(tmp_path), "raw")
    assert plan(conform_reports(raw, invalid="bad")).count("Exchange") == 1
