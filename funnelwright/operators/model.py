"""The star schema: dimensions for dates, leads, places and statuses, and the fact table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.functions import deterministic_uuid, key_text, uuid5
from funnelwright.operators.joins import full_outer_join, left_join

# The range of the date dimension.
FIRST_DATE, LAST_DATE = "2000-01-01", "2030-12-31"

HASHES = ("email_hash", "phone_hash")
LEAD_KEY = (*HASHES, "lead_number")
PLACE = ("city_name", "zip", "state")
STATUS = ("job_status",)

# Fixed value: the fact columns that enter the fact's key, in this order.
FACT_KEY = (
    "entry_date",
    "lead_uuid",
    "place_uuid",
    "status_uuid",
    "date_uuid",
    "appointment_time",
    "demo",
    "set",
    "dispo",
)


def date_dimension(spark: SparkSession, first: str = FIRST_DATE, last: str = LAST_DATE) -> DataFrame:
    """One row per day from ``first`` to ``last``; day_of_week counts from 1 for Sunday."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date_key")
    )
    day = F.col("date_key")
    return days.select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.day(day).alias("day"),
        F.quarter(day).alias("quarter"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "E").alias("day_name"),
        deterministic_uuid(days, "date_key").alias("uuid"),
    )


def lead_contacts(leads: DataFrame) -> DataFrame:
    """Distinct (lead_uuid, email_hash, phone_hash) of the delivered leads."""
    return leads.select("lead_uuid", *HASHES).distinct()


def report_contacts(reports: DataFrame) -> DataFrame:
    """Distinct (email_hash, phone_hash, lead_number) of the reports with their number of rows, ``n_rows``; rows that can
    match no lead are left out.

    The same contact recurs in every snapshot. Its rows collapse to one per map task before they are shuffled.
    """
    return reports.filter(_present(HASHES)).groupBy(*LEAD_KEY).agg(F.count("*").alias("n_rows"))


def match_leads(leads: DataFrame, reports: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """Each lead with every report row that has both its hashes; leads without a report stay, with NULLs.

    ``heavy``: the :func:`heavy_keys` of leads and reports on the hashes.
    """
    return left_join(leads, reports, HASHES, heavy, slice_by=("lead_number",))


def reconcile(leads: DataFrame, reports: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """Leads and report rows side by side, also those that have no counterpart on the other side.

    ``delivered`` and ``reported`` say which sides a row has: a lead that nobody reported has only the first, a report
    row of a lead that was never delivered only the second. ``heavy``: the :func:`heavy_keys` of leads and reports on the hashes.
    """
    return full_outer_join(leads, reports, HASHES, heavy, marks=("delivered", "reported"))


def leads_dimension(contacts: DataFrame, reported: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """Distinct (uuid, lead_number, phone_hash, email_hash) of the leads matched with the reports.

    Takes the :func:`lead_contacts` and the :func:`report_contacts`. As both are distinct, so are the joined rows,
    and there is nothing left to do after the join, where the rows are most. ``heavy``: their :func:`heavy_keys`
    on the hashes.
    """
    matched = match_leads(contacts, reported, heavy)
    return matched.select(F.col("lead_uuid").alias("uuid"), "lead_number", "phone_hash", "email_hash")


def places_dimension(reports: DataFrame, sep: str = "") -> DataFrame:
    return _keyed_members(reports, PLACE, sep)


def status_dimension(reports: DataFrame, sep: str = "") -> DataFrame:
    return _keyed_members(reports, STATUS, sep)


def kpi_fact(
    reports: DataFrame,
    contacts: DataFrame,
    heavy: DataFrame | None = None,
    sep: str = "",
    first_date: str = FIRST_DATE,
    last_date: str = LAST_DATE,
) -> DataFrame:
    """One row per report row and lead it belongs to, with the keys of its dimension members.

    ``contacts`` are the :func:`lead_contacts`, ``heavy`` the :func:`heavy_keys` of reports, or of their
    :func:`report_contacts` with ``n_rows``, and contacts on the hashes. Gives what the joins in :func:`kpi_fact_from_dimensions` give for dimensions
    built from these reports, these leads and this date range, with one join instead of four:

    * Places, statuses and dates have one member per combination of attributes, so a row's key follows from its
      own attributes: the member's UUID, or NULL where an attribute is NULL or the date is out of range. The fact
      rows need not be moved on keys of which a few hold most of the rows.
    * The leads dimension pairs every lead with all report numbers that carry its hashes. A row's own number is
      one of these, so a numbered row belongs to exactly the leads with its hashes.
    """
    with_lead = left_join(reports, contacts, HASHES, heavy, slice_by=("lead_uuid",), required=("lead_number",))
    appointed = F.to_date("appt_date")
    in_range = appointed.between(F.lit(first_date).cast("date"), F.lit(last_date).cast("date"))
    keyed = with_lead.select(
        "*",
        uuid5(_joined_text(reports, PLACE, sep)).alias("place_uuid"),
        uuid5(_joined_text(reports, STATUS, sep)).alias("status_uuid"),
        uuid5(F.when(in_range, appointed.cast("string"))).alias("date_uuid"),
    )
    return _as_fact(keyed, sep)


def kpi_fact_from_dimensions(
    reports: DataFrame,
    d_leads: DataFrame,
    d_places: DataFrame,
    d_date: DataFrame,
    d_status: DataFrame,
    heavy: DataFrame | None = None,
    sep: str = "",
) -> DataFrame:
    """The fact by lookup in given dimension tables, for dimensions that were not built from these reports.

    ``heavy``: the :func:`heavy_keys` of reports and leads dimension on the lead key.
    """
    owners = d_leads.filter(_present(LEAD_KEY)).select(*LEAD_KEY, F.col("uuid").alias("lead_uuid"))
    with_lead = left_join(reports, owners, LEAD_KEY, heavy, slice_by=("lead_uuid",))
    keyed = with_lead.withColumn("date_key", F.to_date("appt_date"))
    keyed = look_up(keyed, d_places, PLACE, "place_uuid")
    keyed = look_up(keyed, d_date, ["date_key"], "date_uuid")
    keyed = look_up(keyed, d_status, STATUS, "status_uuid")
    return _as_fact(keyed, sep)


def look_up(df: DataFrame, dimension: DataFrame, attributes: Sequence[str], key: str) -> DataFrame:
    """Add the UUID of the member with equal ``attributes`` as column ``key``; NULL where there is none.

    No broadcast is forced: Spark broadcasts the dimension if its measured size is below the threshold. Beyond it
    the join shuffles, and adaptive execution splits the partitions of frequent members and of NULL attributes.
    Rows are not set apart as in :func:`left_join`, which would double the plan with each lookup.
    """
    members = dimension.select(*attributes, F.col("uuid").alias(key))
    return df.join(members, list(attributes), "left")


def _as_fact(keyed: DataFrame, sep: str) -> DataFrame:
    fact = keyed.withColumn("appointment_time", F.date_format("appt_date", "HH:mm:ss")).select(*FACT_KEY)
    return fact.select("*", deterministic_uuid(fact, *FACT_KEY, sep=sep).alias("uuid"))


def _keyed_members(reports: DataFrame, attributes: Sequence[str], sep: str) -> DataFrame:
    members = reports.select(*attributes).distinct()
    return members.select("*", deterministic_uuid(members, *attributes, sep=sep).alias("uuid"))


def _joined_text(df: DataFrame, names: Sequence[str], sep: str) -> Column:
    """Key text of a complete combination of attributes, NULL if any of them is NULL."""
    return F.when(_present(names), F.concat_ws(sep, *[key_text(df, name) for name in names]))


def _present(names: Sequence[str]) -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in names])
