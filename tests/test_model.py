import datetime
import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from funnelwright.operators import (
    date_dimension,
    kpi_fact,
    kpi_fact_from_dimensions,
    lead_contacts,
    leads_dimension,
    match_leads,
    places_dimension,
    report_contacts,
    status_dimension,
)

LEADS = "lead_uuid string, email_hash string, phone_hash string"
REPORTS = (
    "entry_date date, lead_number int, phone_hash string, email_hash string, state string, zip int, "
    "appt_date timestamp, demo boolean, set boolean, dispo string, job_status string, city_name string"
)


def key(*parts):
    return str(uuid.uuid5(uuid.NAMESPACE_DNS, "".join(str(part) for part in parts if part is not None)))


def make_tables(seed):
    """Small tables rich in NULLs, copies, shared hashes and numbers, and dates out of range."""
    rng = random.Random(seed)

    def pick(*options):
        return rng.choice(options)

    leads = [(pick("l1", "l2", "l3", None), pick("e1", "e2", "-----", None), pick("p1", "p2", None)) for _ in range(25)]
    reports = [
        (
            pick(None, datetime.date(2023, 3, 24)),
            pick(1, 2, None),
            pick("p1", "p2", None),
            pick("e1", "e2", None),
            pick("TX", "", None),
            pick(12345, 1, None),
            pick(None, datetime.datetime(2023, 3, 4, 14, 5), datetime.datetime(1999, 12, 31, 1), datetime.datetime(2031, 1, 1)),
            pick(True, False, None),
            pick(True, False, None),
            pick("d", None),
            pick("sold", "", None),
            pick("Rome", "Bari", None),
        )
        for _ in range(120)
    ]
    return leads, reports


def expected_leads(leads, reports):
    rows = set()
    for lead, email, phone in leads:
        numbers = [r[1] for r in reports if None not in (email, phone) and (r[3], r[2]) == (email, phone)]
        rows.update((lead, number, phone, email) for number in numbers or [None])
    return rows


def expected_fact(leads, reports):
    rows = Counter()
    owners = expected_leads(leads, reports)
    for entry, number, phone, email, state, zip_code, appt, demo, was_set, dispo, status, city in reports:
        own = [o[0] for o in owners if None not in (number, phone, email) and o[1:] == (number, phone, email)]
        place = key(city, zip_code, state) if None not in (city, zip_code, state) else None
        day = appt and appt.date()
        date = key(day) if day and datetime.date(2000, 1, 1) <= day <= datetime.date(2030, 12, 31) else None
        time = appt and appt.strftime("%H:%M:%S")
        for lead in own or [None]:
            row = (entry, lead, place, key(status) if status is not None else None, date, time, demo, was_set, dispo)
            rows[(*row, key(*row))] += 1
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_model_equals_brute_force(spark, seed):
    lead_rows, report_rows = make_tables(seed)
    leads, reports = spark.createDataFrame(lead_rows, LEADS), spark.createDataFrame(report_rows, REPORTS)
    contacts, reported = lead_contacts(leads), report_contacts(reports)
    heavy = lead_key = None
    if seed != 1:
        slices = "_left_slices int, _right_slices int"
        pairs = [("e1", "p1", 2, 3), ("e2", "p2", 3, 1), ("e2", "p1", 1, 4)]
        heavy = spark.createDataFrame(pairs, f"email_hash string, phone_hash string, {slices}")
        numbered = [(e, p, n, i, j) for e, p, i, j in pairs for n in (1, 2)]
        lead_key = spark.createDataFrame(numbered, f"email_hash string, phone_hash string, lead_number int, {slices}")

    d_leads = leads_dimension(contacts, reported, heavy)
    assert Counter(map(tuple, d_leads.collect())) == Counter(expected_leads(lead_rows, report_rows))

    expected = expected_fact(lead_rows, report_rows)
    assert Counter(map(tuple, kpi_fact(reports, contacts, heavy).collect())) == expected
    looked_up = kpi_fact_from_dimensions(
        reports, d_leads, places_dimension(reports), date_dimension(spark), status_dimension(reports), lead_key
    )
    assert Counter(map(tuple, looked_up.collect())) == expected


def test_lookup_keeps_balanced_joins_beyond_the_broadcast_threshold(spark):
    lead_rows, report_rows = make_tables(4)
    leads, reports = spark.createDataFrame(lead_rows, LEADS), spark.createDataFrame(report_rows, REPORTS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        contacts = lead_contacts(leads)
        looked_up = kpi_fact_from_dimensions(
            reports,
            leads_dimension(contacts, report_contacts(reports)),
            places_dimension(reports),
            date_dimension(spark),
            status_dimension(reports),
        )
        assert Counter(map(tuple, looked_up.collect())) == expected_fact(lead_rows, report_rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_match_leads_keeps_copies(spark):
    leads = spark.createDataFrame([("l", "e", "p"), ("l", "e", "p"), ("m", None, "p")], LEADS)
    reports = spark.createDataFrame([("e", "p", 1), ("e", "p", 1)], "email_hash string, phone_hash string, lead_number int")
    found = Counter(map(tuple, match_leads(leads, reports).select("lead_uuid", "lead_number").collect()))
    assert found == Counter({("l", 1): 4, ("m", None): 1})


def test_date_dimension(spark):
    dates = date_dimension(spark)
    assert dates.count() == 11_323
    row = dates.filter("date_key = '2023-03-24'").first()
    day = datetime.date(2023, 3, 24)
    assert tuple(row) == (day, 2023, 3, 24, 1, 6, "March", "Fri", key(day))
    assert dates.filter("date_key = '2023-03-26'").first().day_of_week == 1
    assert dates.select("uuid").distinct().count() == 11_323
    assert date_dimension(spark, "2024-02-28", "2024-03-01").count() == 3


def test_members_and_their_keys(spark):
    _, report_rows = make_tables(5)
    reports = spark.createDataFrame(report_rows, REPORTS)
    statuses = {(r.job_status, r.uuid) for r in status_dimension(reports).collect()}
    assert statuses == {(status, key(status)) for status in ("sold", "", None)}
    places = list(map(tuple, places_dimension(reports).collect()))
    assert len(places) == len({place[:3] for place in places})
    assert all(place[3] == key(*place[:3]) for place in places)


def test_separator_reaches_dimension_and_fact_alike(spark):
    _, report_rows = make_tables(6)
    reports = spark.createDataFrame(report_rows, REPORTS)
    contacts = lead_contacts(spark.createDataFrame([("l1", "e1", "p1")], LEADS))
    fact = kpi_fact(reports, contacts, sep="|")
    used = {row.place_uuid for row in fact.select("place_uuid").filter(F.col("place_uuid").isNotNull()).collect()}
    assert used and used <= {row.uuid for row in places_dimension(reports, sep="|").collect()}
