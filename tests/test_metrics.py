import random

import pytest
from pyspark.sql import functions as F

from funnelwright.operators import (
    add_up,
    add_up_sketches,
    city_report,
    city_status_report,
    global_report,
    key_audit,
    key_multiplicity,
    level_report,
    month_report,
    null_counts,
    null_percentages,
    sketch_leads,
    status_report,
    tally,
    tally_levels,
    top_and_bottom,
    with_estimate,
)

FACT = "place_uuid string, status_uuid string, date_uuid string, demo boolean, set boolean"
# 's0' is the key of two members and 's9' of none.
STATUSES = [(None, "s0"), ("", "s0"), ("sold", "s1"), ("lost", "s2")]
PLACES = [("Rome", "RM", "p1"), ("Rome", "RM", "p2"), ("Bari", None, "p3"), (None, None, "p4")]
DATES = [(2023, 1, "d1"), (2023, 1, "d2"), (2023, 2, "d3")]


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(3)
    rows = [
        (
            rng.choice(["p1", "p2", "p3", "p4", None]),
            rng.choice(["s0", "s1", "s2", "s9", None]),
            rng.choice(["d1", "d2", "d3", None]),
            rng.choice([True, False, None]),
            rng.choice([True, False, None]),
        )
        for _ in range(400)
    ]
    return (
        rows,
        spark.createDataFrame(rows, FACT),
        spark.createDataFrame(PLACES, "city_name string, state string, uuid string"),
        spark.createDataFrame(STATUSES, "job_status string, uuid string"),
        spark.createDataFrame(DATES, "year int, month int, uuid string"),
    )


def members(dimension, uuid, width):
    return [tuple(row[:width]) for row in dimension if row[-1] == uuid and uuid is not None]


def counted(groups):
    """Group -> counts and rates, from (group, demo, set) triples."""
    result = {}
    for group, demo, was_set in groups:
        n = result.setdefault(group, [0, 0, 0])
        n[0] += 1
        n[1] += was_set is True
        n[2] += was_set is True and demo is True
    return {g: (*n, rate(n[1], n[0]), rate(n[2], n[1])) for g, n in result.items()}


def rate(part, whole):
    return round(part / whole * 100 + 1e-9, 2) if whole else 0.0


def report(frame, width):
    return {tuple(row)[:width]: tuple(row)[width:] for row in frame.collect()}


def test_reports_equal_brute_force(model):
    rows, fact, places, statuses, dates = model
    keys = ["place_uuid", "status_uuid", "date_uuid"]
    # From a tally by just the keys needed and from one by all keys.
    for by in (lambda *names: tally(fact, names), lambda *names: tally(fact, keys)):
        assert report(global_report(by()), 0) == counted(((), d, s) for *_, d, s in rows)
        assert report(month_report(by("date_uuid"), dates), 2) == counted(
            (m, d, s) for _, _, date, d, s in rows for m in members(DATES, date, 2) or [(None, None)]
        )
        assert report(status_report(by("status_uuid"), statuses), 1) == counted(
            (m, d, s) for _, status, _, d, s in rows for m in members(STATUSES, status, 1) or [(None,)]
        )
        assert report(city_status_report(by("place_uuid", "status_uuid"), places, statuses), 2) == counted(
            (p[:1] + m, d, s)
            for place, status, _, d, s in rows
            for m in members(STATUSES, status, 1)
            for p in members(PLACES, place, 2) or [(None, None)]
        )


def test_city_report_has_top_and_bottom(model):
    rows, fact, places, _, _ = model
    by_city = counted((p[::-1], d, s) for place, _, _, d, s in rows for p in members(PLACES, place, 2) or [(None, None)])
    order = lambda item: tuple((part is not None, part or "") for part in item[0])
    top = sorted(by_city.items(), key=lambda item: (-item[1][0], order(item)))[:2]
    bottom = sorted(by_city.items(), key=lambda item: (item[1][0], order(item)))[:2]
    found = [(tuple(row)[:2], tuple(row)[2:]) for row in city_report(tally(fact, ["place_uuid"]), places, 2).collect()]
    assert sorted(found, key=repr) == sorted(top + bottom, key=repr)


def test_reports_are_ordered_by_volume(model):
    _, fact, _, statuses, dates = model
    for frame in (status_report(tally(fact, ["status_uuid"]), statuses), month_report(tally(fact, ["date_uuid"]), dates)):
        volumes = [row.Total_Delivered_Leads for row in frame.collect()]
        assert volumes == sorted(volumes)


def test_reports_of_an_empty_fact(spark, model):
    _, fact, places, statuses, dates = model
    nothing = fact.limit(0)
    assert report(global_report(tally(nothing)), 0) == {(): (0, 0, 0, 0.0, 0.0)}
    assert report(global_report(tally(nothing, ["place_uuid"])), 0) == {(): (0, 0, 0, 0.0, 0.0)}
    assert city_report(tally(nothing, ["place_uuid"]), places).count() == 0


def test_counts_nest(model):
    _, fact, *_ = model
    row = add_up(tally(fact, ["place_uuid"])).first()
    assert row.Total_Demos <= row.Total_Scheduled_Appointments <= row.Total_Delivered_Leads == 400


def test_top_and_bottom_overlap_in_small_tables(spark):
    frame = spark.createDataFrame([("a", 1), (None, 1), ("b", 2)], "k string, n int")
    found = [tuple(row) for row in top_and_bottom(frame, "n", ["k"], 2).collect()]
    assert sorted(found, key=repr) == sorted([("b", 2), (None, 1), (None, 1), ("a", 1)], key=repr)


def test_profiles(spark):
    frame = spark.createDataFrame([(None, "x"), (1, None), (None, None), (2, "y")], "`a.b` int, c string")
    assert null_counts(frame).first().asDict() == {"a.b": 2, "c": 2}
    assert null_percentages(frame).first().asDict() == {"a.b": 50.0, "c": 50.0}
    assert null_percentages(frame.limit(0)).first().asDict() == {"a.b": None, "c": None}


def test_key_audit_and_multiplicity(spark):
    data = [("e", "p", "u", 1), ("e", "p", "u", 1), ("e", "p", None, None), (None, "p", "v", 1), (None, "p", "w", 1)]
    frame = spark.createDataFrame(data + [("f", "p", "x", 1)], "email_hash string, phone_hash string, lead_uuid string, lead_number int")
    audit = {tuple(row)[:2]: tuple(row)[2:] for row in key_audit(frame).collect()}
    assert audit == {("e", "p"): (1, 3, 1, 2), (None, "p"): (2, 2, 0, 2), ("f", "p"): (1, 1, 0, 1)}
    assert key_multiplicity(frame).first().n_keys == 2


def test_sketches_add_up(spark):
    """Sketches of parts, which share leads, tell the whole's distinct leads within four standard errors."""
    rows = spark.range(0, 60_000, 1, 6).selectExpr("CAST(id % 20000 AS STRING) AS lead_uuid", "id DIV 15000 AS batch", "id % 3 AS place")
    rows = rows.unionAll(spark.range(50).selectExpr("CAST(NULL AS STRING)", "0L", "9L"))
    parts = sketch_leads(rows, ["batch", "place"])
    found = {r.place: r.Distinct_Leads_Estimate for r in with_estimate(add_up_sketches(parts, ["place"])).collect()}
    exact = {r.place: r.n for r in rows.groupBy("place").agg(F.count_distinct("lead_uuid").alias("n")).collect()}
    assert found.keys() == exact.keys() and found[9] == exact[9] == 0
    assert all(abs(found[p] - n) <= 0.065 * n for p, n in exact.items())
    whole = with_estimate(add_up_sketches(parts)).first()
    assert abs(whole.Distinct_Leads_Estimate - 20_000) <= 0.065 * 20_000
    few = with_estimate(sketch_leads(rows.filter("CAST(lead_uuid AS INT) < 40"))).first()
    assert few.Distinct_Leads_Estimate == 40


def test_levels_equal_the_single_reports(model):
    """All rows of every report, also where members share a key and where a key has no member."""
    _, fact, places, statuses, dates = model
    tallied = tally(fact, ["place_uuid", "status_uuid", "date_uuid"])
    levels = level_report(tally_levels(tallied), places, dates, statuses)
    counts = ["Total_Delivered_Leads", "Total_Scheduled_Appointments", "Total_Demos", "Conversion_Rate", "Demo_Conversion_Rate"]
    singles = {
        ("global",): (global_report(tallied), []),
        ("city",): (city_report(tallied, places, 100), ["state", "city_name"]),
        ("month",): (month_report(tallied, dates), ["year", "month"]),
        ("status",): (status_report(tallied, statuses), ["job_status"]),
        ("city_status",): (city_status_report(tallied, places, statuses), ["city_name", "job_status"]),
    }
    for (level,), (single, columns) in singles.items():
        own = levels.filter(F.col("level") == level)
        assert report(own.select(*columns, *counts), len(columns)) == report(single.select(*columns, *counts), len(columns))
        assert own.count() == single.distinct().count()
    plan = levels._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1
    assert level_report(tally_levels(tallied.limit(0)), places, dates, statuses).filter("level != 'global'").isEmpty()
