"""Conversion metrics.

All reports start from a *tally*: the fact rows counted per combination of dimension keys. Counts add up, so a
tally can be taken first and the dimension attributes joined to its few rows, instead of joining every fact row.
Members that share a key multiply the tally's rows just as they would multiply fact rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelwright.functions import percentage

# Names of the report columns.
DELIVERED = "Total_Delivered_Leads"
APPOINTMENTS = "Total_Scheduled_Appointments"
DEMOS = "Total_Demos"
CONVERSION = "Conversion_Rate"
DEMO_CONVERSION = "Demo_Conversion_Rate"

COUNTS = (DELIVERED, APPOINTMENTS, DEMOS)

# The dimension keys that the reports need; a tally by these serves all of them.
REPORT_KEYS = ("place_uuid", "status_uuid", "date_uuid")

# The levels of the five reports, and the keys that each counts by.
LEVELS = {
    "global": (),
    "city": ("place_uuid",),
    "month": ("date_uuid",),
    "status": ("status_uuid",),
    "city_status": ("place_uuid", "status_uuid"),
}

# Columns of the sketches of distinct leads and of what they are read as. A sketch of 2^12 registers has 4 KB and a standard
# error of 1.6 percent.
SKETCH, ESTIMATE = "leads_sketch", "Distinct_Leads_Estimate"
DISTINCT = "Distinct_Leads"
SKETCH_BITS = 12


def tally(fact: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Fact rows, rows with an appointment and rows with an appointment and a demo, per combination of ``keys``.

    "Delivered leads" are fact rows, thus report rows. A lead without a report has none and is not counted.
    """
    appointment = F.col("set")
    return fact.groupBy(*keys).agg(
        F.count("*").alias(DELIVERED),
        F.count_if(appointment).alias(APPOINTMENTS),
        F.count_if(appointment & F.col("demo")).alias(DEMOS),
    )


def add_up(tallied: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """A tally by fewer or other keys."""
    return tallied.groupBy(*keys).agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in COUNTS])


def with_rates(tallied: DataFrame) -> DataFrame:
    """Add the share of delivered leads with an appointment, and of appointments with a demo, in percent."""
    return tallied.select(
        "*",
        percentage(F.col(APPOINTMENTS), F.col(DELIVERED)).alias(CONVERSION),
        percentage(F.col(DEMOS), F.col(APPOINTMENTS)).alias(DEMO_CONVERSION),
    )


def with_attributes(
    tallied: DataFrame, dimension: DataFrame, key: str, attributes: Sequence[str | Column], how: str = "left"
) -> DataFrame:
    """Attach dimension attributes to the rows of a tally by the member's UUID."""
    members = dimension.select(F.col("uuid").alias(key), *attributes)
    return tallied.join(members, key, how)


def top_and_bottom(df: DataFrame, measure: str, ties: Sequence[str], k: int = 5) -> DataFrame:
    """The ``k`` rows with the highest and the ``k`` rows with the lowest measure; a row can be in both.

    Equal measures are ordered by ``ties``, NULL first, so the choice is always the same.
    """
    in_order = [F.asc_nulls_first(name) for name in ties]
    highest = df.orderBy(F.desc(measure), *in_order).limit(k)
    lowest = df.orderBy(F.asc(measure), *in_order).limit(k)
    return highest.unionAll(lowest)


def tally_levels(tallied: DataFrame) -> DataFrame:
    """A tally by ``REPORT_KEYS`` added up for all levels of ``LEVELS`` in one pass: column ``level``, the keys, the counts.

    Keys that a level does not count by are NULL in its rows.
    """
    by_level = tallied.groupingSets([[F.col(key) for key in keys] for keys in LEVELS.values()], *REPORT_KEYS)
    summed = by_level.agg(F.grouping_id().alias("_level"), *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in COUNTS])
    level = F.lit(None).cast("string")
    for name, keys in LEVELS.items():  # a bit for each key that a row is summed over, the first key's the highest
        bits = sum(1 << place for place, key in enumerate(reversed(REPORT_KEYS)) if key not in keys)
        level = F.when(F.col("_level") == bits, name).otherwise(level)
    return summed.select(level.alias("level"), *REPORT_KEYS, *COUNTS)


def level_report(levels: DataFrame, d_places: DataFrame, d_date: DataFrame, d_status: DataFrame) -> DataFrame:
    """All rows of all five reports as one table: level, state, city_name, year, month, job_status, counts and rates.

    ``levels`` are the :func:`tally_levels`. Attributes that a level does not report are NULL. Members that share a key multiply the
    rows of the levels that report them, and no others, as in the single reports.
    """
    joined = with_attributes(levels, d_places, "place_uuid", ["state", "city_name"])
    joined = with_attributes(joined, d_date, "date_uuid", ["year", "month"])
    joined = with_attributes(joined, d_status, "status_uuid", ["job_status", F.lit(True).alias("_has_status")])
    joined = joined.filter((F.col("level") != "city_status") | F.col("_has_status"))
    joined = joined.withColumn("state", F.when(F.col("level") != "city_status", F.col("state")))
    return with_rates(add_up(joined, ["level", "state", "city_name", "year", "month", "job_status"]))


def sketch_leads(fact: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sketches of the distinct leads per combination of ``keys``. They add up, see :func:`add_up_sketches`; distinct counts do not."""
    return fact.groupBy(*keys).agg(F.hll_sketch_agg("lead_uuid", F.lit(SKETCH_BITS)).alias(SKETCH))


def add_up_sketches(sketched: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sketches by fewer or other keys: a lead that is in several of them counts once."""
    return sketched.groupBy(*keys).agg(F.hll_union_agg(SKETCH).alias(SKETCH))


def with_estimate(sketched: DataFrame) -> DataFrame:
    """The number of distinct leads as told by the sketch, in its place."""
    return sketched.withColumn(ESTIMATE, F.hll_sketch_estimate(SKETCH)).drop(SKETCH)


def distinct_leads_report(fact: DataFrame, sketched: DataFrame, d_places: DataFrame) -> DataFrame:
    """By city: the exact number of distinct leads, and what the sketches by place say.

    The exact number shuffles each lead once per city; the sketches only their 4 KB per place, whatever the fact has. Cities whose
    facts have no lead have 0 in both.
    """
    city = with_attributes(fact.select("place_uuid", "lead_uuid"), d_places, "place_uuid", ["city_name"])
    exact = city.groupBy("city_name").agg(F.count_distinct("lead_uuid").alias(DISTINCT))
    by_city = add_up_sketches(with_attributes(sketched, d_places, "place_uuid", ["city_name"]), ["city_name"])
    told = with_estimate(by_city).withColumnRenamed("city_name", "_city")
    return exact.join(told, F.col("city_name").eqNullSafe(F.col("_city")), "left").drop("_city")


def global_report(tallied: DataFrame) -> DataFrame:
    return with_rates(add_up(tallied))


def city_report(tallied: DataFrame, d_places: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` busiest and the ``k`` quietest (state, city) pairs."""
    by_place = with_attributes(add_up(tallied, ["place_uuid"]), d_places, "place_uuid", ["state", "city_name"])
    by_city = add_up(by_place, ["state", "city_name"])
    return with_rates(top_and_bottom(by_city, DELIVERED, ["state", "city_name"], k))


def month_report(tallied: DataFrame, d_date: DataFrame) -> DataFrame:
    """By year and month of the appointment; rows without one form a group of their own."""
    by_date = with_attributes(add_up(tallied, ["date_uuid"]), d_date, "date_uuid", ["year", "month"])
    return _by_volume(add_up(by_date, ["year", "month"]), ["year", "month"])


def status_report(tallied: DataFrame, d_status: DataFrame) -> DataFrame:
    by_status = with_attributes(add_up(tallied, ["status_uuid"]), d_status, "status_uuid", ["job_status"])
    return _by_volume(add_up(by_status, ["job_status"]), ["job_status"])


def city_status_report(tallied: DataFrame, d_places: DataFrame, d_status: DataFrame) -> DataFrame:
    """By city and status; fact rows without a status are left out."""
    by_key = add_up(tallied.filter(F.col("status_uuid").isNotNull()), ["place_uuid", "status_uuid"])
    with_status = with_attributes(by_key, d_status, "status_uuid", ["job_status"], "inner")
    with_city = with_attributes(with_status, d_places, "place_uuid", ["city_name"])
    return _by_volume(add_up(with_city, ["city_name", "job_status"]), ["city_name", "job_status"])


def _by_volume(tallied: DataFrame, keys: Sequence[str]) -> DataFrame:
    return with_rates(tallied).orderBy(F.asc(DELIVERED), *[F.asc_nulls_first(key) for key in keys])
