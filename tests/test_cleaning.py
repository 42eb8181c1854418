import datetime

import pytest
from pyspark.sql import functions as F

from funnelwright.operators import (
    clean,
    conform,
    count_invalid,
    invalid_values,
    null_sentinels,
    project_to_spec,
    union_all_by_name,
)
from funnelwright.plans import conform_reports
from funnelwright.specs import Field, TableSpec, get_spec, report_spec, specs_from_json


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_clean_drops_copies_and_empty_rows(spark):
    raw = spark.createDataFrame([(None, None), (None, ""), (None, ""), (" a  b", "x"), ("a b ", "x")], "p string, q string")
    assert rows(clean(raw)) == sorted([(None, ""), ("a b", "x")], key=repr)


def test_clean_keeps_copies_of_different_sources(spark):
    data = [("f1", "a"), ("f1", "a "), ("f2", "a"), ("f2", None)]
    raw = spark.createDataFrame(data, "file string, p string")
    assert rows(clean(raw, "file")) == [("f1", "a"), ("f2", "a")]


def test_clean_takes_any_column_name_and_type(spark):
    raw = spark.createDataFrame([(1, True, 2.5), (1, True, 2.5)], "`x.y` int, `a ``b` boolean, `Appt Date` double")
    cleaned = clean(raw)
    assert cleaned.columns == raw.columns
    assert rows(cleaned) == [("1", "true", "2.5")]


def test_null_sentinels(spark):
    raw = spark.createDataFrame([("-----", "-----"), (None, "a"), ("a", "n/a")], "p string, q string")
    found = rows(null_sentinels(raw, ["p"], ["-----", "n/a"]))
    assert found == sorted([(None, "-----"), (None, "a"), ("a", "n/a")], key=repr)
    with pytest.raises(ValueError, match="nope"):
        null_sentinels(raw, ["nope"], ["-----"])


def test_projection_renames_in_input_order_and_takes_the_first_alias_present(spark):
    raw = spark.createDataFrame([("b", "x", "a", "1")], "CityName string, extra string, CITY string, ZIP string")
    projected = project_to_spec(raw, get_spec("reports"))
    assert projected.columns == ["city_name", "zip"]
    assert rows(projected) == [("a", "1")]
    assert project_to_spec(raw.drop("CITY"), get_spec("reports")).first().city_name == "b"
    # Names are case-sensitive.
    assert project_to_spec(raw.select("extra", F.col("CITY").alias("City")), get_spec("reports")).columns == []


RAW = {
    "ENTRYDATE": "3/24/2023", "LEADNUMBER": "7", "phone_hash": "p", "email_hash": "-----", "STATE": "7", "ZIP": "1234",
    "Appt Date": "-----", "Demo": "maybe", "Set": "TRUE", "Dispo": "-----", "Job Status": "ok", "CityName": "Rome",
}


def raw_report(spark, **changes):
    record = {**RAW, **changes}
    schema = ", ".join(f"`{name}` string" for name in record)
    return spark.createDataFrame([tuple(record.values())], schema)


def test_conform_types_and_names(spark):
    conformed = conform(raw_report(spark), get_spec("reports"))
    assert dict(conformed.dtypes) == {
        "entry_date": "date", "lead_number": "int", "phone_hash": "string", "email_hash": "string", "state": "string",
        "zip": "int", "appt_date": "timestamp", "demo": "boolean", "set": "boolean", "dispo": "string",
        "job_status": "string", "city_name": "string",
    }
    expected = (datetime.date(2023, 3, 24), 7, "p", "-----", None, None, None, None, True, "-----", "ok", "Rome")
    assert rows(conformed) == [expected]


def test_conform_keeps_typed_columns_and_skips_missing_ones(spark):
    spec = TableSpec("t", (Field(("d",), "date", format="M/d/yyyy"), Field(("gone",), "integer"), Field(("s",), "other")))
    frame = spark.createDataFrame([(datetime.date(2020, 1, 2), 5)], "d date, s int")
    assert rows(conform(frame, spec)) == [(datetime.date(2020, 1, 2), "5")]


def test_entry_date_pattern_is_configuration(spark):
    verbatim = conform(raw_report(spark, ENTRYDATE="03/24/2023"), report_spec("mm/dd/yyy"))
    assert verbatim.first().entry_date == datetime.date(2023, 1, 24)


def test_invalid_values(spark):
    raw = union_all_by_name([raw_report(spark), raw_report(spark), raw_report(spark, STATE=None, Demo="0", ZIP="12345-6789")])
    expected = [
        ("Appt Date", "-----", 3), ("Demo", "maybe", 2), ("STATE", "7", 2), ("ZIP", "1234", 2), ("ZIP", "12345-6789", 1),
    ]
    assert rows(invalid_values(raw, get_spec("reports"))) == expected


def test_invalid_values_are_recorded_with_the_row(spark):
    conformed = conform_reports(raw_report(spark), invalid="bad")
    assert [tuple(loss) for loss in conformed.first().bad] == [
        ("STATE", "7"), ("ZIP", "1234"), ("Appt Date", "-----"), ("Demo", "maybe"),
    ]
    assert count_invalid(conformed, "bad").count() == 4
    fine = conform_reports(raw_report(spark, STATE="TX", ZIP="01234", **{"Appt Date": None}, Demo="1"), invalid="bad")
    assert fine.first().bad is None
    assert count_invalid(fine, "bad").count() == 0


def test_stage_order_sentinels_after_typing(spark):
    row = conform_reports(raw_report(spark)).first()
    assert (row.email_hash, row.dispo, row.appt_date, row.job_status) == (None, None, None, "ok")


def test_union_all_by_name(spark):
    one, two = spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([(3, 4)], "a int, c int")
    assert rows(union_all_by_name([one, None, two])) == [(1, 2, None), (3, None, 4)]
    assert union_all_by_name([None]) is None
    assert union_all_by_name([None, one]) is one


def test_unknown_spec():
    with pytest.raises(ValueError, match="orders"):
        get_spec("orders")


def test_specs_from_json():
    text = """{"input_schemas": [{"name": "t", "entries": [
        {"name": ["A", "B"], "new_name": "c", "type": "integer", "format": "[0-9]"}, {"name": "D e", "type": "string"}]}]}"""
    spec = get_spec("t", specs_from_json(text))
    assert spec.fields == (Field(("A", "B"), "integer", "c", "[0-9]"), Field(("D e",), "string"))
    assert spec.fields[1].target_for("D e") == "d_e"


def test_shipped_specs_can_be_planned_in_later_joins(spark):
    """A predicate over all columns used to make planning of such joins exponential in their number."""
    reports = conform_reports(raw_report(spark))
    joined = reports.join(reports.select("email_hash", "phone_hash", F.lit(1).alias("one")), ["email_hash", "phone_hash"], "left")
    assert joined.filter("one is not null").count() == 0
