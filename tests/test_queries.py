"""Every registered query gives the rows of its SQL."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from verification import oracles
from verification.compare import differences
from verification.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    answer = contract.queries()[name](spark, SF)
    assert differences(answer, SF, name) is None
    plan = answer._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracles.oracle_sql())
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    row = contract.entry(spark).first()
    assert 0 < row.Total_Demos <= row.Total_Scheduled_Appointments <= row.Total_Delivered_Leads


def test_known_counts_of_the_test_tables(spark):
    reports = contract.queries()["step1_reports"](spark, "/root/testdata/sf0.01")
    row = reports.selectExpr(
        "count(*) AS n", "count(entry_date) AS dates", "count(appt_date) AS appointments", "count(zip) AS zips",
        "count_if(email_hash IS NULL) AS keyless", "count(DISTINCT city_name) AS cities",
    ).first()
    assert tuple(row) == (15_000, 15_000, 10_021, 14_716, 1_500, 25)


def test_reports_agree_with_each_other(spark):
    run = {name: contract.queries()[name](spark, SF) for name in ("kpi_global", "kpi_by_month", "kpi_by_status")}
    counts = ("Total_Delivered_Leads", "Total_Scheduled_Appointments", "Total_Demos")
    totals = {name: tuple(frame.groupBy().sum(*counts).first()) for name, frame in run.items()}
    assert len(set(totals.values())) == 1
    by_city_status = contract.queries()["kpi_by_city_status"](spark, SF)
    without_status = run["kpi_by_status"].filter("job_status IS NULL").first().Total_Delivered_Leads
    delivered = totals["kpi_global"][0]
    assert by_city_status.groupBy().sum(counts[0]).first()[0] == delivered - without_status
    assert delivered >= contract.queries()["row_count"](spark, SF).first().n_rows


def test_two_snapshots_are_read_from_the_given_tables_alone(spark, tmp_path):
    """Nothing is stored in between, as each row is read once; and a snapshot is named by its return flag as it is."""
    sf = str(tmp_path)
    for name in ("customer", "nation", "orders"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{sf}/{name}.parquet")
    items = spark.read.parquet(f"{SF}/lineitem.parquet")
    flags = ["A", "A", "R", "R", "R", "N", "A ", None]  # of one order's items
    flag = F.element_at(F.array(*[F.lit(flag) for flag in flags]), F.col("n"))
    one = items.limit(1).drop("l_returnflag").crossJoin(spark.range(1, len(flags) + 1).select(F.col("id").cast("int").alias("n")))
    one.withColumn("l_returnflag", flag).drop("n").write.parquet(f"{sf}/lineitem.parquet")
    for name, rows in (("snapshot_kept", 2), ("snapshot_removed", 0), ("snapshot_added", 1)):
        answer = contract.queries()[name](spark, sf)
        assert answer.count() == rows
        assert all(sf in file for file in answer.inputFiles())
