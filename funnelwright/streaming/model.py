"""The reports kept up to date: counts of the fact change by what new leads and new report rows bring.

A fact row is a report row with a lead, or alone if it has none. So new report rows bring their rows of the fact; new leads bring a
row for each older report row with their hashes, and those of these rows that had no lead before lose the row they had alone.
Only counts are kept, by the keys that reports need; they add up over batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.operators.joins import heavy_keys, unmatched
from funnelwright.operators.metrics import (
    COUNTS,
    REPORT_KEYS,
    add_up,
    city_report,
    city_status_report,
    global_report,
    month_report,
    status_report,
    tally,
)
from funnelwright.operators.model import (
    FIRST_DATE,
    HASHES,
    LAST_DATE,
    PLACE,
    STATUS,
    date_dimension,
    kpi_fact,
    lead_contacts,
    places_dimension,
    report_contacts,
    status_dimension,
)
from funnelwright.operators.union import union_all_by_name
from funnelwright.sources.tables import last_batch, read_batches, read_table, write_batch, write_table

# Tables below the model's folder, a batch per step: counts of the fact, distinct contacts, combinations of places and statuses,
# and up to which batches of leads and reports a step has gone.
TALLY, CONTACTS, MEMBERS, PROGRESS = "kpi_tally_steps", "lead_contact_steps", "member_steps", "progress_steps"


def increment_model(
    spark: SparkSession, conformed: str, out: str, first_date: str = FIRST_DATE, last_date: str = LAST_DATE
) -> DataFrame:
    """Take the batches of ``leads`` and ``reports`` that are new since the last step into the tally, which is returned.

    A step that dies is done again: its number is only left behind once all its tables are written, and a table's batch replaces
    itself. Older report rows are read when there are new leads, and moved only where they have the hashes of one. Batches that no
    step has taken must not be merged.
    """
    step = last_batch(spark, out, PROGRESS) + 1
    before = read_batches(spark, out, PROGRESS)
    done = before.agg(F.max("leads").alias("leads"), F.max("reports").alias("reports")).first() if before is not None else None
    leads_done, reports_done = (done.leads, done.reports) if done else (-1, -1)
    leads_last, reports_last = last_batch(spark, conformed, "leads"), last_batch(spark, conformed, "reports")
    if (leads_last, reports_last) == (leads_done, reports_done):
        return increments_tally(spark, out)

    known = read_batches(spark, out, CONTACTS, through=step - 1)
    leads = read_batches(spark, conformed, "leads", leads_done, leads_last)
    new_contacts = lead_contacts(leads) if leads is not None else None
    if new_contacts is not None:
        new_contacts = write_batch(new_contacts if known is None else new_contacts.subtract(known), out, CONTACTS, step)
    if known is None:
        known = _no_contacts(spark)
    contacts = known if new_contacts is None else union_all_by_name([known, new_contacts])

    reports = read_batches(spark, conformed, "reports", reports_done, reports_last)
    older = read_batches(spark, conformed, "reports", through=reports_done) if reports_done >= 0 else None
    changes = []
    dates = {"first_date": first_date, "last_date": last_date}
    if reports is not None:
        write_batch(reports.select(*PLACE, *STATUS).distinct(), out, MEMBERS, step)
        changes.append(tally(_fact(reports, contacts, out, "new", dates), REPORT_KEYS))
    if older is not None and new_contacts is not None and not new_contacts.isEmpty():
        changes += _of_new_leads(older, known, new_contacts, out, dates)
    if changes:
        write_batch(add_up(union_all_by_name(changes), REPORT_KEYS), out, TALLY, step)
    write_batch(spark.range(1).select(F.lit(leads_last).alias("leads"), F.lit(reports_last).alias("reports")), out, PROGRESS, step)
    return increments_tally(spark, out)


def increments_tally(spark: SparkSession, out: str) -> DataFrame:
    """The fact counted by ``REPORT_KEYS``, as the steps so far add up to; combinations that have no rows any more are left out."""
    return add_up(read_table(spark, out, TALLY), REPORT_KEYS).filter(F.col(COUNTS[0]) > 0)


def increments_reports(
    spark: SparkSession, out: str, first_date: str = FIRST_DATE, last_date: str = LAST_DATE
) -> dict[str, DataFrame]:
    """The five reports over what the steps so far have taken."""
    tallied, members = increments_tally(spark, out), read_table(spark, out, MEMBERS)
    d_date, d_places, d_status = date_dimension(spark, first_date, last_date), places_dimension(members), status_dimension(members)
    return {
        "global": global_report(tallied),
        "city": city_report(tallied, d_places),
        "month": month_report(tallied, d_date),
        "status": status_report(tallied, d_status),
        "city_status": city_status_report(tallied, d_places, d_status),
    }


def _of_new_leads(older: DataFrame, known: DataFrame, new: DataFrame, out: str, dates: dict[str, str]) -> list[DataFrame]:
    """Counts that older report rows gain with new leads, and as negative ones those of the rows they had alone."""
    keys = new.filter(_present(HASHES)).select(*HASHES).distinct()
    touched = older.filter(_present([*HASHES, "lead_number"])).join(keys, list(HASHES), "left_semi")
    touched = write_table(touched, out, "touched_reports")
    gained = tally(_fact(touched, new, out, "gained", dates), REPORT_KEYS)
    alone = unmatched(touched, known, HASHES, write_table(heavy_keys(touched, known, HASHES), out, "heavy_alone"))
    lost = tally(kpi_fact(alone, _no_contacts(new.sparkSession), **dates), REPORT_KEYS)
    return [gained, lost.withColumns({name: -F.col(name) for name in COUNTS})]


def _fact(reports: DataFrame, contacts: DataFrame, out: str, name: str, dates: dict[str, str]) -> DataFrame:
    heavy = heavy_keys(report_contacts(reports), contacts, HASHES, left_rows="n_rows")
    return kpi_fact(reports, contacts, write_table(heavy, out, f"heavy_{name}"), **dates)


def _no_contacts(spark: SparkSession) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return spark.range(0).select(*[nothing.alias(name) for name in ("lead_uuid", *HASHES)])


def _present(names: Sequence[str]):
    found = F.lit(True)
    for name in names:
        found &= F.col(name).isNotNull()
    return found
