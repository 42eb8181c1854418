"""The registered queries: every operator, run over the whole test tables."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.functions import deterministic_uuid, parse_date, quoted
from funnelwright.operators import (
    added,
    as_of_join,
    city_report,
    city_status_report,
    clean,
    conform,
    date_dimension,
    distinct_leads_report,
    global_report,
    heavy_keys,
    invalid_values,
    key_audit,
    kept,
    key_multiplicity,
    kpi_fact,
    kpi_fact_from_dimensions,
    latest_state,
    lead_contacts,
    leads_dimension,
    level_report,
    match_leads,
    month_report,
    normalise_text,
    null_counts,
    null_percentages,
    null_sentinels,
    places_dimension,
    project_to_spec,
    reconcile,
    removed,
    report_contacts,
    sketch_leads,
    status_changes,
    status_dimension,
    status_report,
    tally,
    tally_levels,
    union_all_by_name,
    unmatched,
)
from funnelwright.operators.history import asked_times, of_crowded_keys
from funnelwright.operators.joins import LEAST_ROWS
from funnelwright.operators.metrics import DISTINCT, ESTIMATE, REPORT_KEYS
from funnelwright.operators.model import HASHES, LEAD_KEY
from funnelwright.plans import (
    build_model,
    conform_leads,
    conform_reports,
    ingest_leads,
    ingest_reports,
    kpi_reports,
    register_views,
)
from funnelwright.plans.sizing import sized_for
from funnelwright.sources import merge_batches, read_table, write_table
from funnelwright.sources.tables import remove, without_leftovers
from funnelwright.specs import SENTINEL_COLUMNS, SENTINELS, VERBATIM_ENTRY_DATE, Field, TableSpec, get_spec
from funnelwright.streaming import (
    increment_leads,
    increment_model,
    increment_reports,
    increments_reports,
    invalid_values_of_increments,
)
from verification.fixture import (
    COPIES_SHARE,
    raw_deliveries,
    raw_leads,
    raw_reports,
    raw_snapshots,
    skewed_deliveries,
    skewed_leads,
    skewed_reports,
    snapshot_lines,
    snapshots_of,
    unreported_leads,
)
from verification.scratch import scratch_folder

REPORTS = get_spec("reports")

# A limit for heavy keys at which the skewed tables have some on both sides, at every scale.
FEW_ROWS = 3

# Rows from which a key is cut by time in the skewed tables: the hot key at every scale, and no other.
CROWD = 300

# Bytes of a raw snapshot row in a task against those of its line item on disk; and compressed bytes of shuffled line items, of
# which a task makes raw rows.
RAW_EXPANSION = 25
MERGED_RAW_BYTES = 8 << 20

# The snapshots' texts are six times the tables' bytes, and stay while all else is written.
_COMPRESSED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_leads(raw_leads(spark, sf_dir))


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_reports(raw_reports(spark, sf_dir))


def _comparable(df: DataFrame) -> DataFrame:
    """Timestamps without time zone, as the SQL check has them."""
    return df.withColumn("appt_date", F.col("appt_date").cast("timestamp_ntz"))


def _stored(df: DataFrame) -> DataFrame:
    """``df`` written to a table and read back, for intermediate results that a query reads more than once."""
    return write_table(df, scratch_folder(df.sparkSession), "table")


def _stored_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The leads' contacts and the reports."""
    return _stored(lead_contacts(_leads(spark, sf_dir))), _stored(_reports(spark, sf_dir))


def _fact_of(contacts: DataFrame, reports: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    return kpi_fact(reports, contacts, _stored(heavy_keys(reports, contacts, HASHES, least_rows)))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact_of(*_stored_tables(spark, sf_dir))


def _clean_reports(spark, sf_dir):
    return clean(raw_reports(spark, sf_dir))


def _clean_snapshots(spark, sf_dir):
    """Written here, as task sizes must follow the input while it runs: a task holds its distinct rows."""
    tables = [f"{sf_dir}/{name}.parquet" for name in ("lineitem", "orders", "customer")]
    with sized_for(spark, *tables, expansion=RAW_EXPANSION, merge_to=MERGED_RAW_BYTES):
        return _stored(clean(raw_snapshots(spark, sf_dir), "snapshot"))


def _null_sentinels(spark, sf_dir):
    return null_sentinels(project_to_spec(raw_reports(spark, sf_dir), REPORTS), SENTINEL_COLUMNS, SENTINELS)


def _conform_reports(spark, sf_dir):
    return _comparable(conform(clean(raw_reports(spark, sf_dir)), REPORTS))


def _step1_reports(spark, sf_dir):
    return _comparable(_reports(spark, sf_dir))


def _invalid_values(spark, sf_dir):
    return invalid_values(clean(raw_reports(spark, sf_dir)), REPORTS)


def _union_by_name(spark, sf_dir):
    return _comparable(union_all_by_name([_leads(spark, sf_dir), _reports(spark, sf_dir)]))


def _uuid5_key(spark, sf_dir):
    reports = _reports(spark, sf_dir)
    names = ("entry_date", "lead_number", "demo", "appt_date", "dispo", "job_status")
    return reports.select("lead_number", deterministic_uuid(reports, *names).alias("uuid"))


def _parse_entry_date_verbatim(spark, sf_dir):
    parsed = parse_date(F.col("ENTRYDATE"), VERBATIM_ENTRY_DATE)
    return raw_reports(spark, sf_dir).select(F.col("LEADNUMBER").alias("leadnumber"), parsed.alias("entry_date"))


def _lead_match(spark, sf_dir):
    return _match_of(_leads(spark, sf_dir), _reports(spark, sf_dir))


def _match_of(leads: DataFrame, reports: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    leads = _stored(leads)
    reports = _stored(reports.select(*HASHES, "lead_number", "appt_date", "job_status"))
    return _comparable(match_leads(leads, reports, _stored(heavy_keys(leads, reports, HASHES, least_rows))))


def _dim_date(spark, sf_dir):
    appointments = _reports(spark, sf_dir).groupBy(F.to_date("appt_date").alias("date_key")).agg(
        F.count("*").alias("n_appointments")
    )
    counted = date_dimension(spark).join(appointments, "date_key", "left")
    return counted.withColumn("n_appointments", F.coalesce("n_appointments", F.lit(0)))


def _d_leads_of(contacts: DataFrame, reports: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    reported = _stored(report_contacts(reports))
    return leads_dimension(contacts, reported, _stored(heavy_keys(contacts, reported, HASHES, least_rows)))


def _dim_leads(spark, sf_dir):
    return _d_leads_of(*_stored_tables(spark, sf_dir))


def _dim_places(spark, sf_dir):
    return places_dimension(_reports(spark, sf_dir))


def _dim_status(spark, sf_dir):
    return status_dimension(_reports(spark, sf_dir))


def _fact_from_dimensions(spark, sf_dir):
    contacts, reports = _stored_tables(spark, sf_dir)
    d_leads = _stored(_d_leads_of(contacts, reports))
    return kpi_fact_from_dimensions(
        reports,
        d_leads,
        places_dimension(reports),
        date_dimension(spark),
        status_dimension(reports),
        _stored(heavy_keys(reports, d_leads, LEAD_KEY)),
    )


def _lead_match_skewed(spark, sf_dir):
    return _match_of(conform_leads(skewed_leads(spark, sf_dir)), conform_reports(skewed_reports(spark, sf_dir)), FEW_ROWS)


def _skewed_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    contacts = lead_contacts(conform_leads(skewed_leads(spark, sf_dir)))
    return _stored(contacts), _stored(conform_reports(skewed_reports(spark, sf_dir)))


def _dim_leads_skewed(spark, sf_dir):
    return _d_leads_of(*_skewed_tables(spark, sf_dir), FEW_ROWS)


def _fact_skewed(spark, sf_dir):
    return _fact_of(*_skewed_tables(spark, sf_dir), FEW_ROWS)


def _kpi_global(spark, sf_dir):
    return global_report(tally(_fact(spark, sf_dir)))


def _kpi_top_bottom_city(spark, sf_dir):
    contacts, reports = _stored_tables(spark, sf_dir)
    tallied = _stored(tally(_fact_of(contacts, reports), ["place_uuid"]))
    return city_report(tallied, places_dimension(reports))


def _kpi_by_month(spark, sf_dir):
    return month_report(tally(_fact(spark, sf_dir), ["date_uuid"]), date_dimension(spark))


def _kpi_by_status(spark, sf_dir):
    contacts, reports = _stored_tables(spark, sf_dir)
    return status_report(tally(_fact_of(contacts, reports), ["status_uuid"]), status_dimension(reports))


def _kpi_by_city_status(spark, sf_dir):
    contacts, reports = _stored_tables(spark, sf_dir)
    tallied = tally(_fact_of(contacts, reports), ["place_uuid", "status_uuid"])
    return city_status_report(tallied, places_dimension(reports), status_dimension(reports))


STATUS_SQL = """
WITH counted AS (
  SELECT s.job_status, count(*) AS leads, count_if(f.set) AS appointments, count_if(f.set AND f.demo) AS demos
  FROM kpi_calculation f LEFT JOIN d_status s ON s.uuid = f.status_uuid
  GROUP BY s.job_status
)
SELECT job_status, leads, appointments, demos, coalesce(round(try_divide(demos, appointments) * 100, 2), 0D) AS demo_rate
FROM counted ORDER BY leads
"""


def _sql_over_views(spark, sf_dir):
    contacts, reports = _stored_tables(spark, sf_dir)
    root = scratch_folder(spark)
    write_table(_fact_of(contacts, reports), root, "kpi_calculation")
    write_table(status_dimension(reports), root, "status")
    register_views(spark, root, {"kpi_calculation": "kpi_calculation", "d_status": "status"})
    return spark.sql(STATUS_SQL)


def _row_count(spark, sf_dir):
    return _reports(spark, sf_dir).agg(F.count("*").alias("n_rows"))


def _null_counts(spark, sf_dir):
    return null_counts(_reports(spark, sf_dir))


def _null_percentages(spark, sf_dir):
    return null_percentages(_reports(spark, sf_dir))


def _key_audit(spark, sf_dir):
    return key_audit(_leads(spark, sf_dir))


def _key_audit_reports(spark, sf_dir):
    return key_audit(_reports(spark, sf_dir), entity="lead_number")


def _key_multiplicity(spark, sf_dir):
    return key_multiplicity(_reports(spark, sf_dir))


def _write_csv_snapshots(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """The three snapshots as CSV files; returns the glob of the folders written. Their lines go."""
    written = list(_csv_snapshots_in_turn(spark, sf_dir, folder))[-1]
    remove(spark, f"{folder}/_source")
    return written


def _csv_snapshots_in_turn(spark: SparkSession, sf_dir: str, folder: str) -> Iterator[str]:
    """The three snapshots as compressed CSV files; one has ``CITY`` for ``CityName``, an extra column and another order.

    Gives the glob of the folders each time that one is written. Copies of a row are looked for within a file, so rows are
    assigned to files by their content, all but the column whose whitespace differs between copies. They are stored and moved
    as lines, and their texts made where they are written.
    """
    lines = write_table(snapshot_lines(spark, sf_dir), folder, "_source")
    columns = [name for name in snapshots_of(lines).columns if name != "snapshot"]
    as_is = [quoted(name) for name in columns]
    other = [quoted(name).alias("CITY" if name == "CityName" else name) for name in reversed(columns)]
    layouts = {"snapshot-A": as_is, "snapshot-N": [F.lit("x").alias("Remark.1"), *other], "snapshot-R": as_is}
    for snapshot, layout in layouts.items():
        mine = lines.filter(F.col("l_returnflag") == snapshot.removeprefix("snapshot-"))
        rows = snapshots_of(mine.repartition(*[F.expr(shared) for shared in COPIES_SHARE])).select(layout)
        keep_spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        with without_leftovers(spark):
            rows.write.options(header=True, **keep_spaces, **_COMPRESSED).csv(f"{folder}/{snapshot}")
        yield f"{folder}/snapshot-*"


def _csv_snapshots(spark, sf_dir):
    folder = scratch_folder(spark)
    reports, _ = ingest_reports(spark, _write_csv_snapshots(spark, sf_dir, f"{folder}/raw"), f"{folder}/step1")
    return _comparable(reports.drop("invalid_values"))


def _csv_invalid_values(spark, sf_dir):
    folder = scratch_folder(spark)
    ingest_reports(spark, _write_csv_snapshots(spark, sf_dir, f"{folder}/raw"), f"{folder}/step1")
    return read_table(spark, f"{folder}/step1", "report_invalid_values")


def _parquet_leads(spark, sf_dir):
    folder = scratch_folder(spark)
    raw_leads(spark, sf_dir).write.parquet(f"{folder}/raw")
    return ingest_leads(spark, f"{folder}/raw", f"{folder}/step1")


def _write_lead_variants(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """The leads as Parquet files of four schemas: as they are, a number as key, another name of the key, and a column less."""
    raw = _stored(raw_leads(spark, sf_dir))
    number = F.substring_index("lead_UUID", "-", -1).cast("int")
    variants = [
        raw,
        raw.withColumn("lead_UUID", number),
        raw.withColumnRenamed("lead_UUID", "LeadId"),
        raw.drop("email_hash"),
    ]
    for turn, variant in enumerate(variants):
        key = F.col("LeadId" if "LeadId" in variant.columns else "lead_UUID").cast("string")
        mine = F.substring_index(key, "-", -1).cast("int") % len(variants) == turn
        variant.filter(mine).write.mode("append").parquet(folder)
    return folder


def _parquet_leads_variants(spark, sf_dir):
    folder = scratch_folder(spark)
    plain = get_spec("leads")
    key = Field(("lead_UUID", "LeadId"), new_name="lead_uuid")
    spec = TableSpec("leads", (key, *[field for field in plain.fields if "lead_UUID" not in field.names]))
    return ingest_leads(spark, _write_lead_variants(spark, sf_dir, f"{folder}/raw"), f"{folder}/step1", spec)


def _stored_model_by_city_status(spark, sf_dir):
    """All three jobs, from raw files to the last report."""
    folder = scratch_folder(spark)
    raw_leads(spark, sf_dir).write.parquet(f"{folder}/leads")
    ingest_leads(spark, f"{folder}/leads", f"{folder}/step1")
    ingest_reports(spark, _write_csv_snapshots(spark, sf_dir, f"{folder}/reports"), f"{folder}/step1")
    build_model(spark, f"{folder}/step1", f"{folder}/step2")
    return kpi_reports(spark, f"{folder}/step2")["city_status"]


def _latest_state(spark, sf_dir):
    return _comparable(latest_state(_reports(spark, sf_dir), HASHES, ("entry_date", "lead_number")))


def _latest_state_skewed(spark, sf_dir):
    return _comparable(latest_state(conform_reports(skewed_reports(spark, sf_dir)), HASHES, ("entry_date", "lead_number")))


def _changes_of(reports: DataFrame) -> DataFrame:
    states = reports.select(*HASHES, "entry_date", "lead_number", "job_status")
    return status_changes(states, HASHES, "entry_date", ("lead_number", "job_status"), "job_status")


def _status_changes(spark, sf_dir):
    return _changes_of(_stored(_reports(spark, sf_dir)))


def _status_changes_skewed(spark, sf_dir):
    return _changes_of(_stored(conform_reports(skewed_reports(spark, sf_dir))))


def _reconciled_of(leads: DataFrame, reports: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    leads, reports = _stored(leads), _stored(reports.select(*HASHES, "lead_number", "appt_date", "job_status"))
    return _comparable(reconcile(leads, reports, _stored(heavy_keys(leads, reports, HASHES, least_rows))))


def _reconciled(spark, sf_dir):
    return _reconciled_of(_leads(spark, sf_dir), _reports(spark, sf_dir))


def _reconciled_skewed(spark, sf_dir):
    return _reconciled_of(conform_leads(skewed_leads(spark, sf_dir)), conform_reports(skewed_reports(spark, sf_dir)), FEW_ROWS)


def _unmatched_of(left: DataFrame, right: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    left, right = _stored(left), _stored(right.select(*HASHES))
    return unmatched(left, right, HASHES, _stored(heavy_keys(left, right, HASHES, least_rows)))


def _unmatched_leads(spark, sf_dir):
    return _unmatched_of(_leads(spark, sf_dir), _reports(spark, sf_dir))


def _unmatched_reports(spark, sf_dir):
    return _comparable(_unmatched_of(_reports(spark, sf_dir), _leads(spark, sf_dir)))


def _unmatched_leads_skewed(spark, sf_dir):
    return _unmatched_of(conform_leads(unreported_leads(spark, sf_dir)), _reports(spark, sf_dir), FEW_ROWS)


def _unmatched_reports_skewed(spark, sf_dir):
    leads = conform_leads(unreported_leads(spark, sf_dir))
    return _comparable(_unmatched_of(conform_reports(skewed_reports(spark, sf_dir)), leads, FEW_ROWS))


def _next_report_of(deliveries: DataFrame, reports: DataFrame, least_rows: int = LEAST_ROWS, crowd: int = LEAST_ROWS) -> DataFrame:
    deliveries = _stored(deliveries)
    offers = _stored(reports.select(*HASHES, F.col("entry_date").alias("reported_on"), "lead_number", "job_status"))
    crowded = _stored(heavy_keys(deliveries, offers, HASHES, crowd))
    many = of_crowded_keys(deliveries, crowded, HASHES)
    asked = asked_times(many, HASHES, "delivered_on")
    heavy = _stored(heavy_keys(many, asked, [*HASHES, "delivered_on"], least_rows))
    return as_of_join(deliveries, offers, HASHES, "delivered_on", "reported_on", ties=("lead_number",), heavy=heavy, crowded=crowded)


def _next_report(spark, sf_dir):
    return _next_report_of(raw_deliveries(spark, sf_dir), _reports(spark, sf_dir))


def _next_report_skewed(spark, sf_dir):
    return _next_report_of(skewed_deliveries(spark, sf_dir), conform_reports(skewed_reports(spark, sf_dir)), FEW_ROWS, CROWD)


def _kpi_levels(spark, sf_dir):
    contacts, reports = _stored_tables(spark, sf_dir)
    levels = tally_levels(tally(_fact_of(contacts, reports), REPORT_KEYS))
    return level_report(levels, places_dimension(reports), date_dimension(spark), status_dimension(reports))


def _distinct_leads(spark, sf_dir):
    """Exact numbers, and whether the sketches are off by four standard errors (6.5 percent) at most."""
    contacts, reports = _stored_tables(spark, sf_dir)
    fact = _stored(_fact_of(contacts, reports))
    found = distinct_leads_report(fact, sketch_leads(fact, ["place_uuid"]), places_dimension(reports))
    off = F.abs(F.col(ESTIMATE) - F.col(DISTINCT))
    return found.select("city_name", DISTINCT, (off <= F.ceil(0.065 * F.col(DISTINCT))).alias("close"))


def _two_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The rows of two snapshots, with copies.

    Not stored: each snapshot is read once, so of the third one no row is joined, cleaned or written.
    """
    raw = raw_snapshots(spark, sf_dir)
    return tuple(normalise_text(raw.filter(F.col("snapshot") == f"snapshot-{name}").drop("snapshot", "Dispo")) for name in "AR")


def _snapshot_added(spark, sf_dir):
    return added(*_two_snapshots(spark, sf_dir))


def _snapshot_removed(spark, sf_dir):
    return removed(*_two_snapshots(spark, sf_dir))


def _snapshot_kept(spark, sf_dir):
    return kept(*_two_snapshots(spark, sf_dir))


def _grown_step1(spark: SparkSession, sf_dir: str) -> str:
    """Reports and leads taken in a run for each snapshot that arrives, the first two merged in between."""
    folder = scratch_folder(spark)
    leads = raw_leads(spark, sf_dir)
    third = F.pmod(F.xxhash64("lead_UUID"), F.lit(3))
    for turn, pattern in enumerate(_csv_snapshots_in_turn(spark, sf_dir, f"{folder}/reports")):
        leads.filter(third == turn).write.mode("append").parquet(f"{folder}/leads")
        increment_reports(spark, pattern, f"{folder}/step1", files_per_batch=5)
        increment_leads(spark, f"{folder}/leads", f"{folder}/step1")
        if turn == 1:
            merge_batches(spark, f"{folder}/step1", "reports")
    return f"{folder}/step1"


def _incremental_tally(spark, sf_dir):
    """The last report after a step for each snapshot, with leads that arrive after their reports."""
    folder = scratch_folder(spark)
    leads = raw_leads(spark, sf_dir)
    for turn, pattern in enumerate(_csv_snapshots_in_turn(spark, sf_dir, f"{folder}/reports")):
        increment_reports(spark, pattern, f"{folder}/step1")
        if turn:
            leads.filter(F.pmod(F.xxhash64("lead_UUID"), F.lit(2)) == turn - 1).write.mode("append").parquet(f"{folder}/leads")
            increment_leads(spark, f"{folder}/leads", f"{folder}/step1")
        increment_model(spark, f"{folder}/step1", f"{folder}/step2")
    return increments_reports(spark, f"{folder}/step2")["city_status"]


def _incremental_reports(spark, sf_dir):
    reports = read_table(spark, _grown_step1(spark, sf_dir), "reports")
    return _comparable(reports.drop("invalid_values", "source_file", "source_time"))


def _incremental_invalid_values(spark, sf_dir):
    return invalid_values_of_increments(spark, _grown_step1(spark, sf_dir))


def _incremental_by_city_status(spark, sf_dir):
    """The last report over tables that have grown in several runs."""
    step1 = _grown_step1(spark, sf_dir)
    build_model(spark, step1, f"{step1}-model")
    return kpi_reports(spark, f"{step1}-model")["city_status"]


QUERIES = {
    "clean_reports": _clean_reports,
    "clean_snapshots": _clean_snapshots,
    "null_sentinels": _null_sentinels,
    "conform_reports": _conform_reports,
    "conform_leads": _leads,
    "step1_reports": _step1_reports,
    "invalid_values": _invalid_values,
    "union_by_name": _union_by_name,
    "uuid5_key": _uuid5_key,
    "parse_entry_date_verbatim": _parse_entry_date_verbatim,
    "lead_match": _lead_match,
    "lead_match_skewed": _lead_match_skewed,
    "dim_leads_skewed": _dim_leads_skewed,
    "fact_kpi_skewed": _fact_skewed,
    "dim_date": _dim_date,
    "dim_leads": _dim_leads,
    "dim_places": _dim_places,
    "dim_status": _dim_status,
    "fact_kpi": _fact,
    "fact_kpi_from_dimensions": _fact_from_dimensions,
    "kpi_global": _kpi_global,
    "kpi_top_bottom_city": _kpi_top_bottom_city,
    "kpi_by_month": _kpi_by_month,
    "kpi_by_status": _kpi_by_status,
    "kpi_by_city_status": _kpi_by_city_status,
    "sql_over_views": _sql_over_views,
    "row_count": _row_count,
    "null_counts": _null_counts,
    "null_percentages": _null_percentages,
    "key_audit": _key_audit,
    "key_audit_reports": _key_audit_reports,
    "key_multiplicity": _key_multiplicity,
    "csv_snapshots": _csv_snapshots,
    "csv_invalid_values": _csv_invalid_values,
    "parquet_leads": _parquet_leads,
    "parquet_leads_variants": _parquet_leads_variants,
    "stored_model_by_city_status": _stored_model_by_city_status,
    "incremental_reports": _incremental_reports,
    "incremental_tally": _incremental_tally,
    "incremental_invalid_values": _incremental_invalid_values,
    "incremental_by_city_status": _incremental_by_city_status,
    "latest_state": _latest_state,
    "latest_state_skewed": _latest_state_skewed,
    "status_changes": _status_changes,
    "status_changes_skewed": _status_changes_skewed,
    "reconciled": _reconciled,
    "reconciled_skewed": _reconciled_skewed,
    "unmatched_leads": _unmatched_leads,
    "unmatched_leads_skewed": _unmatched_leads_skewed,
    "unmatched_reports": _unmatched_reports,
    "unmatched_reports_skewed": _unmatched_reports_skewed,
    "next_report": _next_report,
    "next_report_skewed": _next_report_skewed,
    "kpi_levels": _kpi_levels,
    "distinct_leads": _distinct_leads,
    "snapshot_added": _snapshot_added,
    "snapshot_removed": _snapshot_removed,
    "snapshot_kept": _snapshot_kept,
}
