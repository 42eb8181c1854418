import gzip
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from funnelwright.__main__ import main
from funnelwright.plans import build_model, ingest_leads, ingest_reports, kpi_reports
from funnelwright.sources import merge_batches, read_table, tables, write_batch, write_table
from funnelwright.specs import get_spec
from funnelwright.streaming import (
    increment_leads,
    increment_model,
    increment_reports,
    increments,
    increments_reports,
    invalid_values_of_increments,
    model,
)

# Headers of a report.
HEADER = "ENTRYDATE,LEADNUMBER,phone_hash,email_hash,STATE,ZIP,Appt Date,Demo,Set,Dispo,Job Status,CITY"


def report(number, city="Rome", appointment="3/6/2023 2:30PM"):
    return f"3/4/2023,{number},p{number},e{number},TX,12345,{appointment},true,1, sale  made ,Sold,{city}"


def put(folder, name, *rows, header=HEADER):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([header, *rows]) + "\n")


def rows(frame):
    names = sorted(set(frame.columns) - {"source_file", "source_time", "invalid_values"})
    return Counter(map(tuple, frame.select(*names).collect()))


@pytest.fixture()
def folders(tmp_path):
    return tmp_path / "in", str(tmp_path / "grown"), str(tmp_path / "whole")


def test_runs_over_a_growing_folder_equal_one_run(spark, folders):
    source, grown, whole = folders
    put(source, "a.csv", report(1), report(1), report(2))
    put(source, "b.csv", report(1), header=HEADER.replace("CITY", "CityName"))
    put(source, "empty.csv")
    (source / "nothing.csv").write_text("")
    assert increment_reports(spark, str(source), grown).count() == 3
    assert increment_reports(spark, str(source), grown).count() == 3  # nothing new
    put(source, "c.csv", report(3, appointment="soon"), report(1))
    put(source, "d.csv", report(4), report("x"), header=HEADER + ",Extra")
    put(source, "notes.txt", report(5))
    found = increment_reports(spark, str(source), grown, files_per_batch=1)
    expected, _ = ingest_reports(spark, str(source), whole)
    assert rows(found) == rows(expected)
    assert rows(invalid_values_of_increments(spark, grown)) == rows(read_table(spark, whole, "report_invalid_values"))
    assert {row.source_file.rsplit("/", 1)[-1] for row in found.select("source_file").distinct().collect()} == {"a.csv", "b.csv", "c.csv", "d.csv"}
    assert found.filter("source_time IS NULL").isEmpty()
    merge_batches(spark, grown, "reports")
    assert rows(increment_reports(spark, str(source), grown)) == rows(expected)


def test_columns_that_files_lack_are_there(spark, folders):
    source, grown, _ = folders
    put(source, "a.csv", "7", header="LEADNUMBER")
    first = increment_reports(spark, str(source), grown)
    put(source, "b.csv", report(1))
    second = increment_reports(spark, str(source), grown)
    assert first.dtypes == second.dtypes
    assert len(second.columns) == len(get_spec("reports").fields) + 3
    assert Counter((row.lead_number, row.city_name) for row in second.collect()) == Counter([(7, None), (1, "Rome")])


@pytest.mark.parametrize("dies", ["before", "after"])
def test_a_run_that_dies_is_taken_up(spark, folders, monkeypatch, dies):
    """The batch's rows may be there already when the run dies, before the stream knows that the batch has ended."""
    source, grown, whole = folders
    put(source, "a.csv", report(1), report(2))
    increment_reports(spark, str(source), grown)
    put(source, "b.csv", report(2))
    put(source, "c.csv", report(3))
    write, died = tables.write_batch, []

    def write_once(frame, root, name, number):
        if dies == "after":
            write(frame, root, name, number)
        died.append(number)
        raise RuntimeError("the run died")

    monkeypatch.setattr(increments, "write_batch", write_once)
    with pytest.raises(Exception, match="the run died"):
        increment_reports(spark, str(source), grown)
    assert died == [1]
    monkeypatch.setattr(increments, "write_batch", write)
    put(source, "d.csv", report(4))
    found = increment_reports(spark, str(source), grown)
    assert rows(found) == rows(ingest_reports(spark, str(source), whole)[0])


def test_leads_and_the_model_over_increments(spark, folders, tmp_path):
    source, grown, whole = folders
    leads = tmp_path / "leads"

    def deliver(name, data, columns="lead_UUID string, phone_hash string, email_hash string"):
        spark.createDataFrame(data, columns).coalesce(1).write.mode("append").parquet(str(leads / name))

    for turn in range(2):
        put(source, f"{turn}.csv", report(1), report(turn + 2))
        deliver(f"{turn}.parquet", [(f"l{turn}", f"p{turn + 1}", f"e{turn + 1}")])
        increment_reports(spark, str(source), grown)
        increment_leads(spark, f"{leads}/*", grown)
    deliver("2.parquet", [(7, "p9")], "lead_UUID int, phone_hash string")
    found = increment_leads(spark, f"{leads}/*", grown)
    assert dict(found.dtypes)["lead_uuid"] == "string"
    assert rows(found) == Counter([("e1", "l0", "p1"), ("e2", "l1", "p2"), (None, "7", "p9")])

    ingest_reports(spark, str(source), whole)
    ingest_leads(spark, str(leads), whole)
    for out in (grown, whole):
        build_model(spark, out, f"{out}-model")
    ours, theirs = (kpi_reports(spark, f"{out}-model") for out in (grown, whole))
    assert {name: rows(frame) for name, frame in ours.items()} == {name: rows(frame) for name, frame in theirs.items()}


def test_command_line(spark, folders, tmp_path, capsys):
    source, grown, _ = folders
    leads = tmp_path / "leads"
    put(source, "a.csv", report(1), report("x"))
    spark.createDataFrame([("l1", "p1", "e1")], "lead_UUID string, phone_hash string, email_hash string").write.parquet(str(leads))
    place = [f"--leads={leads}", f"--reports={source}", f"--out={grown}"]
    main(["increment", *place])
    put(source, "b.csv", report(2))
    main(["increment", *place, "--merge"])
    main(["increment", *place])
    assert "LEADNUMBER" in capsys.readouterr().out
    assert read_table(spark, grown, "reports").count() == 3 and read_table(spark, grown, "leads").count() == 1
    put(source, "c.csv", report(2).replace("Sold", "Lost"), report(3))
    main(["increment", *place])
    main(["history", f"--conformed={grown}", f"--out={grown}-history"])
    tables = {name: read_table(spark, f"{grown}-history", name) for name in ("latest_state", "status_changes", "unmatched_leads", "unmatched_reports")}
    assert {(r.lead_number, r.job_status) for r in tables["latest_state"].collect()} == {(None, "Sold"), (1, "Sold"), (2, "Lost"), (3, "Sold")}
    assert Counter((r.lead_number, r.job_status, r.previous_job_status) for r in tables["status_changes"].collect()) == Counter(
        [(None, "Sold", None), (1, "Sold", None), (2, "Sold", None), (2, "Lost", "Sold"), (3, "Sold", None)]
    )
    assert tables["unmatched_leads"].isEmpty()
    assert sorted(r.email_hash for r in tables["unmatched_reports"].collect()) == ["e2", "e2", "e3", "ex"]
    main(["model", f"--conformed={grown}", f"--out={grown}-model"])
    assert read_table(spark, f"{grown}-model", "kpi_calculation").count() == 5


def test_reports_follow_the_increments(spark, tmp_path):
    """After every step, in which leads or reports arrive in any order, the reports are those of a model built anew."""
    draw = random.Random(4)
    step1, out = f"{tmp_path}/step1", f"{tmp_path}/steps"
    leads, reports = [], []

    def lead(n):
        return (draw.choice([f"l{n}", f"l{n}", f"m{n}", None]), f"p{n}" if n < 9 else None, f"e{n}")

    def row(n):
        appointment = draw.choice([None, "2023-03-06 14:30:00", "2023-04-01 09:00:00"])
        return (
            "2023-03-04", draw.choice([n, n + 100, None]), draw.choice([f"p{n}", None]) if n == 3 else f"p{n}", f"e{n}", draw.choice(["TX", None]), 12345,
            appointment, draw.choice([True, False, None]), draw.choice([True, False, None]), "sale", draw.choice(["Sold", "Lost", None]), draw.choice(["Rome", "Bari"]),
        )

    kind = "entry_date string, lead_number int, phone_hash string, email_hash string, state string, zip int, appt_date string, demo boolean, set boolean, dispo string, job_status string, city_name string"
    arrivals = [("reports", 12), ("leads", 4), ("both", 12), ("leads", 5)]
    numbers = {"leads": 0, "reports": 0}
    for what, n in arrivals:
        for name, make, held, schema in (("leads", lead, leads, "lead_uuid string, phone_hash string, email_hash string"), ("reports", row, reports, kind)):
            if what in (name, "both"):
                new = [make(draw.randrange(8)) for _ in range(n)]
                held += new
                frame = spark.createDataFrame(new, schema)
                if name == "reports":
                    frame = frame.withColumns({"entry_date": F.to_date("entry_date"), "appt_date": F.to_timestamp("appt_date")})
                write_batch(frame, step1, name, numbers[name])
                numbers[name] += 1
        tallied = increment_model(spark, step1, out)
        whole = f"{tmp_path}/whole-{numbers['leads']}-{numbers['reports']}-{what}"
        write_table(read_table(spark, step1, "reports"), whole, "reports")
        none = spark.range(0).selectExpr("'' AS lead_uuid", "'' AS phone_hash", "'' AS email_hash")
        write_table(read_table(spark, step1, "leads") if numbers["leads"] else none, whole, "leads")
        build_model(spark, whole, f"{whole}-model")
        assert rows(tallied) == rows(read_table(spark, f"{whole}-model", "kpi_tally")), what
    ours, theirs = increments_reports(spark, out), kpi_reports(spark, f"{whole}-model")
    assert {name: rows(frame) for name, frame in ours.items()} == {name: rows(frame) for name, frame in theirs.items()}


def test_a_step_that_dies_is_done_again(spark, tmp_path, monkeypatch):
    step1, out = f"{tmp_path}/step1", f"{tmp_path}/steps"
    conformed = "CAST('2023-03-04' AS DATE) entry_date, 1 lead_number, 'p' phone_hash, 'e' email_hash, 'TX' state, 1 zip, CAST(NULL AS TIMESTAMP) appt_date, true demo, true set, 'x' dispo, 'Sold' job_status, 'Rome' city_name"
    write_batch(spark.sql(f"SELECT {conformed}"), step1, "reports", 0)
    increment_model(spark, step1, out)
    write_batch(spark.sql("SELECT 'l' lead_uuid, 'p' phone_hash, 'e' email_hash UNION ALL SELECT 'm', 'p', 'e'"), step1, "leads", 0)
    write = model.write_batch

    def write_all_but_progress(frame, root, name, number):
        if name == model.PROGRESS:
            raise RuntimeError("the step died")
        return write(frame, root, name, number)

    monkeypatch.setattr(model, "write_batch", write_all_but_progress)
    with pytest.raises(RuntimeError, match="the step died"):
        increment_model(spark, step1, out)
    monkeypatch.setattr(model, "write_batch", write)
    write_batch(spark.sql(f"SELECT {conformed}"), step1, "reports", 1)
    assert increment_model(spark, step1, out).first().Total_Delivered_Leads == 4
    assert increment_model(spark, step1, out).first().Total_Delivered_Leads == 4


def test_compressed_files_are_taken_too(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    put(source, "a.csv", report(1))
    increment_reports(spark, str(source), out)
    (source / "b.csv.gz").write_bytes(gzip.compress("\n".join([HEADER, report(2), report(2), report(3)]).encode()))
    found = increment_reports(spark, str(source), out)
    assert sorted(row.source_file.rsplit("/", 1)[-1] for row in found.collect()) == ["a.csv", "b.csv.gz", "b.csv.gz"]
