"""Ingest, model and report.

A stored table ends every lineage, so a lost executor costs at most the running job's own stages.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from funnelwright.operators.cleaning import clean, conform, count_invalid, null_sentinels
from funnelwright.operators.joins import crowds, slices_of
from funnelwright.operators.metrics import (
    REPORT_KEYS,
    city_report,
    city_status_report,
    global_report,
    month_report,
    level_report,
    sketch_leads,
    status_report,
    tally,
    tally_levels,
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
    leads_dimension,
    places_dimension,
    report_contacts,
    status_dimension,
)
from funnelwright.plans.sizing import sized_for, sized_for_bytes
from funnelwright.sources.files import SOURCE_FILE, csv_bytes, read_csv_folder, read_parquet_folder
from funnelwright.sources.tables import read_table, write_table
from funnelwright.specs import SENTINEL_COLUMNS, SENTINELS, SPECS, TableSpec

# Parquet is encoded and compressed; rows in a shuffle take several times the space.
PARQUET_EXPANSION = 4

# Column of the stored reports that keeps the raw values lost in typing; see ``conform``.
INVALID = "invalid_values"


def conform_leads(
    raw: DataFrame, source: str | Sequence[str] | None = None, spec: TableSpec = SPECS["leads"], keep: Sequence[str] = ()
) -> DataFrame:
    return conform(clean(raw, source), spec, keep=keep)


def conform_reports(
    raw: DataFrame,
    source: str | Sequence[str] | None = None,
    spec: TableSpec = SPECS["reports"],
    invalid: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Clean, type, then turn filler values into NULL. Filler in a typed column thus counts as invalid.

    ``keep``: columns of ``source`` that the result has too.
    """
    return null_sentinels(conform(clean(raw, source), spec, invalid, keep), SENTINEL_COLUMNS, SENTINELS)


def ingest_leads(spark: SparkSession, folder: str, out: str, spec: TableSpec = SPECS["leads"]) -> DataFrame:
    """Parquet files in ``folder`` -> table ``leads``."""
    with sized_for(spark, folder, expansion=PARQUET_EXPANSION):
        return write_table(conform_leads(read_parquet_folder(spark, folder, spec), SOURCE_FILE, spec), out, "leads")


def ingest_reports(
    spark: SparkSession, folder: str, out: str, spec: TableSpec = SPECS["reports"]
) -> tuple[DataFrame, int]:
    """CSV files in ``folder`` -> tables ``reports`` and ``report_invalid_values``; returns reports and row count.

    The raw files are read once. The row count rides along with the write, and the invalid values are counted from
    the small column of the stored table that holds them.
    """
    raw = read_csv_folder(spark, folder, spec)
    written = Observation("reports")
    conformed = conform_reports(raw, SOURCE_FILE, spec, INVALID).observe(written, F.count(F.lit(1)).alias("rows"))
    with sized_for_bytes(spark, csv_bytes(spark, folder)):
        stored = write_table(conformed, out, "reports")
        write_table(count_invalid(stored, INVALID), out, "report_invalid_values")
    return stored, written.get["rows"]


def build_model(
    spark: SparkSession, conformed: str, out: str, first_date: str = FIRST_DATE, last_date: str = LAST_DATE
) -> DataFrame:
    """Tables ``leads`` and ``reports`` -> ``date``, ``leads``, ``places``, ``status``, ``kpi_calculation``.

    More tables stay next to them: ``members``, the combinations of places and statuses, ``lead_contacts``, ``report_contacts``, their heavy keys ``heavy_contacts`` and
    ``heavy_reports`` and the counts that both are made of, ``crowds``, ``kpi_tally``, the fact counted by all dimension keys, which the reports read, and ``lead_sketches``, the
    distinct leads by place.
    """
    with sized_for(spark, conformed, expansion=PARQUET_EXPANSION):
        reports = read_table(spark, conformed, "reports")
        write_table(date_dimension(spark, first_date, last_date), out, "date")
        members = write_table(reports.select(*PLACE, *STATUS).distinct(), out, "members")
        write_table(places_dimension(members), out, "places")
        write_table(status_dimension(members), out, "status")
        # Stored, as each is read twice or more below.
        contacts = write_table(lead_contacts(read_table(spark, conformed, "leads")), out, "lead_contacts")
        reported = write_table(report_contacts(reports), out, "report_contacts")
        rows = F.count(F.lit(1))
        sides = [(contacts, {"contacts": rows}), (reported, {"numbers": rows, "reports": F.sum("n_rows")})]
        counted = write_table(crowds(sides, HASHES), out, "crowds")
        crowded = write_table(slices_of(counted, HASHES, "contacts", "numbers"), out, "heavy_contacts")
        write_table(leads_dimension(contacts, reported, crowded), out, "leads")
        repeated = write_table(slices_of(counted, HASHES, "reports", "contacts"), out, "heavy_reports")
        fact = kpi_fact(reports, contacts, repeated, first_date=first_date, last_date=last_date)
        stored = write_table(fact, out, "kpi_calculation")
        write_table(tally(stored, REPORT_KEYS), out, "kpi_tally")
        write_table(sketch_leads(stored, ["place_uuid"]), out, "lead_sketches")
        return stored


def kpi_reports(spark: SparkSession, model: str) -> dict[str, DataFrame]:
    """The five reports over a stored model, which this only reads: every report adds up the model's tally."""
    d_date, d_places, d_status = (read_table(spark, model, name) for name in ("date", "places", "status"))
    tallied = read_table(spark, model, "kpi_tally")
    return {
        "global": global_report(tallied),
        "city": city_report(tallied, d_places),
        "month": month_report(tallied, d_date),
        "status": status_report(tallied, d_status),
        "city_status": city_status_report(tallied, d_places, d_status),
    }


def kpi_level_report(spark: SparkSession, model: str) -> DataFrame:
    """The rows of all five reports as one table, from one scan of the model's tally."""
    d_date, d_places, d_status = (read_table(spark, model, name) for name in ("date", "places", "status"))
    return level_report(tally_levels(read_table(spark, model, "kpi_tally")), d_places, d_date, d_status)


# The names under which SQL text refers to the stored tables.
MODEL_VIEWS = {
    "d_dates": "date",
    "d_leads": "leads",
    "d_places": "places",
    "d_status": "status",
    "kpi_calculation": "kpi_calculation",
}


def register_views(spark: SparkSession, root: str, views: Mapping[str, str] = MODEL_VIEWS) -> None:
    """Make stored tables known to ``spark.sql`` under their view names."""
    for view, table in views.items():
        read_table(spark, root, table).createOrReplaceTempView(view)
