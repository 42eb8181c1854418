"""The expected answers as DuckDB SQL, written independently of the library."""

from __future__ import annotations

from verification.fixture import (
    HEADERS,
    RAW_DELIVERIES,
    RAW_LEADS,
    RAW_REPORTS,
    RAW_SNAPSHOTS,
    SKEWED_DELIVERIES,
    SKEWED_LEADS,
    SKEWED_REPORTS,
    TABLES,
    UNREPORTED_LEADS,
)


def _plain(sql: str) -> str:
    return sql.format(**{name: name for name in TABLES})


def _squeeze(column: str) -> str:
    return f"trim(regexp_replace({column}, '\\s+', ' ', 'g'))"


def _whole_number(text: str) -> str:
    return f"TRY_CAST(regexp_extract({text}, '^\\s*([+-]?[0-9]+)([.][0-9]*)?\\s*$', 1) AS INTEGER)"


def _truth(text: str) -> str:
    return f"CASE lower({text}) WHEN 'true' THEN true WHEN '1' THEN true WHEN 'false' THEN false WHEN '0' THEN false END"


def _uuid(text: str) -> str:
    digest = f"sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode({text}))"
    return (
        f"(SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' "
        f"|| substr('89ab', 1 + CAST(('0x' || substr(h, 17, 1)) AS INTEGER) % 4, 1) || substr(h, 18, 3) || '-' "
        f"|| substr(h, 21, 12) FROM (SELECT {digest} AS h))"
    )


def _text(column: str, kind: str = "text") -> str:
    if kind == "bool":
        return f"CASE {column} WHEN true THEN 'True' WHEN false THEN 'False' END"
    return f"CAST({column} AS VARCHAR)"


_CLEAN = ", ".join(f"{_squeeze(name)} AS {name}" for name in HEADERS)

_TYPED = f"""
  CAST(try_strptime(entrydate, '%m/%d/%Y') AS DATE) AS entry_date,
  {_whole_number('leadnumber')} AS lead_number,
  phone_hash, email_hash,
  CASE WHEN regexp_matches(state, '[a-zA-Z]{{2}}') THEN state END AS state,
  CASE WHEN regexp_matches(zip, '[0-9]{{5}}') THEN {_whole_number('zip')} END AS zip,
  try_strptime(appt_date_raw, '%m/%d/%Y %I:%M%p') AS appt_date,
  {_truth('demo')} AS demo,
  {_truth('set_raw')} AS "set",
  dispo, job_status_raw AS job_status, cityname AS city_name
"""

_STEP1 = """
  entry_date, lead_number, nullif(phone_hash, '-----') AS phone_hash, nullif(email_hash, '-----') AS email_hash,
  state, zip, appt_date, demo, "set", nullif(dispo, '-----') AS dispo, nullif(job_status, '-----') AS job_status,
  nullif(city_name, '-----') AS city_name
"""

_FACT_KEY = "concat_ws('', " + ", ".join(
    [
        _text("entry_date"),
        "lead_uuid",
        "place_uuid",
        "status_uuid",
        "date_uuid",
        "appointment_time",
        _text("demo", "bool"),
        _text('"set"', "bool"),
        "dispo",
    ]
) + ")"

# Named relations; each may use those above it.
_RELATIONS = {
    "raw_leads": _plain(RAW_LEADS),
    "raw_reports": _plain(RAW_REPORTS),
    "raw_snapshots": _plain(RAW_SNAPSHOTS),
    "raw_deliveries": _plain(RAW_DELIVERIES),
    "leads": f"SELECT DISTINCT {_squeeze('lead_UUID')} AS lead_uuid, {_squeeze('phone_hash')} AS phone_hash, "
    f"{_squeeze('email_hash')} AS email_hash FROM raw_leads",
    "cleaned": f"SELECT DISTINCT {_CLEAN} FROM raw_reports",
    "cleaned_snapshots": f"SELECT DISTINCT snapshot, {_CLEAN} FROM raw_snapshots",
    "typed": f"SELECT {_TYPED} FROM cleaned",
    "reports": f"SELECT {_STEP1} FROM typed",
    "snapshot_reports": f"SELECT {_STEP1} FROM (SELECT {_TYPED} FROM cleaned_snapshots)",
    "days": "SELECT CAST(d AS DATE) AS date_key "
    "FROM generate_series(DATE '2000-01-01', DATE '2030-12-31', INTERVAL 1 DAY) AS g(d)",
    "d_date": f"""SELECT date_key, CAST(year(date_key) AS INTEGER) AS year, CAST(month(date_key) AS INTEGER) AS month,
        CAST(day(date_key) AS INTEGER) AS day, CAST(quarter(date_key) AS INTEGER) AS quarter,
        CAST(dayofweek(date_key) + 1 AS INTEGER) AS day_of_week, strftime(date_key, '%B') AS month_name,
        strftime(date_key, '%a') AS day_name, {_uuid(_text('date_key'))} AS uuid FROM days""",
    "d_leads": """SELECT DISTINCT l.lead_uuid AS uuid, r.lead_number, l.phone_hash, l.email_hash FROM leads l
        LEFT JOIN reports r ON r.phone_hash = l.phone_hash AND r.email_hash = l.email_hash""",
    "d_places": f"""SELECT *, {_uuid("concat_ws('', city_name, CAST(zip AS VARCHAR), state)")} AS uuid
        FROM (SELECT DISTINCT city_name, zip, state FROM reports)""",
    "d_status": f"""SELECT *, {_uuid("coalesce(job_status, '')")} AS uuid
        FROM (SELECT DISTINCT job_status FROM reports)""",
}


def _fact_of(reports: str) -> str:
    return f"""SELECT *, {_uuid(_FACT_KEY)} AS uuid FROM (
        SELECT r.entry_date, l.uuid AS lead_uuid, p.uuid AS place_uuid, s.uuid AS status_uuid, d.uuid AS date_uuid,
               strftime(r.appt_date, '%H:%M:%S') AS appointment_time, r.demo, r."set", r.dispo
        FROM {reports} r
        LEFT JOIN d_leads l
          ON l.lead_number = r.lead_number AND l.phone_hash = r.phone_hash AND l.email_hash = r.email_hash
        LEFT JOIN d_places p ON p.state = r.state AND p.zip = r.zip AND p.city_name = r.city_name
        LEFT JOIN d_date d ON d.date_key = CAST(r.appt_date AS DATE)
        LEFT JOIN d_status s ON s.job_status = r.job_status)"""


# The same relations over other raw tables.
_SKEWED_REPORTS = {"raw_reports": _plain(SKEWED_REPORTS), "raw_deliveries": _plain(SKEWED_DELIVERIES)}
_SKEWED = {"raw_leads": _plain(SKEWED_LEADS)} | _SKEWED_REPORTS
_UNREPORTED = {"raw_leads": _plain(UNREPORTED_LEADS)}

_RELATIONS["fact"] = _fact_of("reports")
_RELATIONS["snapshot_fact"] = _fact_of("snapshot_reports")


def _query(select: str, **others: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in (_RELATIONS | others).items()) + "\n" + select


def _rated(keys: str, source: str) -> str:
    """Counts and rates of ``source`` by ``keys``; every fact row is joined to its dimension members first."""
    listed, grouped = (f"{keys}, ", f"GROUP BY {keys}") if keys else ("", "")
    return f"""SELECT *,
        coalesce(round(Total_Scheduled_Appointments / nullif(Total_Delivered_Leads, 0) * 100, 2), 0) AS Conversion_Rate,
        coalesce(round(Total_Demos / nullif(Total_Scheduled_Appointments, 0) * 100, 2), 0) AS Demo_Conversion_Rate
        FROM (SELECT {listed}count(*) AS Total_Delivered_Leads,
                     count(CASE WHEN "set" THEN 1 END) AS Total_Scheduled_Appointments,
                     count(CASE WHEN "set" AND demo THEN 1 END) AS Total_Demos FROM {source} {grouped})"""


_BY_CITY = _rated("state, city_name", "fact f LEFT JOIN d_places p ON p.uuid = f.place_uuid")
_BY_MONTH = _rated("year, month", "fact f LEFT JOIN d_date d ON d.uuid = f.date_uuid")
_BY_STATUS = _rated("job_status", "fact f LEFT JOIN d_status s ON s.uuid = f.status_uuid")


def _by_city_status(fact: str) -> str:
    return _rated(
        "city_name, job_status",
        f"{fact} f JOIN d_status s ON s.uuid = f.status_uuid LEFT JOIN d_places p ON p.uuid = f.place_uuid",
    )


_TOP_BOTTOM = f"""SELECT * FROM (SELECT * FROM ({_BY_CITY})
  ORDER BY Total_Delivered_Leads DESC, state NULLS FIRST, city_name NULLS FIRST LIMIT 5)
UNION ALL
SELECT * FROM (SELECT * FROM ({_BY_CITY})
  ORDER BY Total_Delivered_Leads ASC, state NULLS FIRST, city_name NULLS FIRST LIMIT 5)"""

_REPORT_COLUMNS = (
    "entry_date lead_number phone_hash email_hash state zip appt_date demo set dispo job_status city_name".split()
)

# The order in which the latest state is looked for: the given columns, then the others as they stand.
_STATE_ORDER = "entry_date lead_number state zip appt_date demo set dispo job_status city_name".split()

_HEADERED = ", ".join(f'{name} AS "{header}"' for name, header in HEADERS.items())

# Raw column, header, and the typed value that is NULL when the raw one does not fit.
_CHECKED = (
    ("entrydate", "ENTRYDATE", "try_strptime(entrydate, '%m/%d/%Y')"),
    ("leadnumber", "LEADNUMBER", _whole_number("leadnumber")),
    ("state", "STATE", "CASE WHEN regexp_matches(state, '[a-zA-Z]{2}') THEN state END"),
    ("zip", "ZIP", f"CASE WHEN regexp_matches(zip, '[0-9]{{5}}') THEN {_whole_number('zip')} END"),
    ("appt_date_raw", "Appt Date", "try_strptime(appt_date_raw, '%m/%d/%Y %I:%M%p')"),
    ("demo", "Demo", _truth("demo")),
    ("set_raw", "Set", _truth("set_raw")),
)


def _invalid(source: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{header}' AS column_name, {raw} AS raw_value, count(*) AS n_rows FROM {source} "
        f"WHERE {raw} IS NOT NULL AND ({typed}) IS NULL GROUP BY {raw}"
        for raw, header, typed in _CHECKED
    )


_ORACLES = {
    "clean_reports": f"SELECT {_HEADERED} FROM cleaned",
    "clean_snapshots": f"SELECT snapshot, {_HEADERED} FROM cleaned_snapshots",
    "null_sentinels": "SELECT entrydate AS entry_date, leadnumber AS lead_number, state, zip, "
    "appt_date_raw AS appt_date, demo, set_raw AS \"set\", nullif(phone_hash, '-----') AS phone_hash, "
    "nullif(email_hash, '-----') AS email_hash, nullif(dispo, '-----') AS dispo, "
    "nullif(job_status_raw, '-----') AS job_status, nullif(cityname, '-----') AS city_name FROM raw_reports",
    "conform_reports": "SELECT * FROM typed",
    "conform_leads": "SELECT * FROM leads",
    "step1_reports": "SELECT * FROM reports",
    "invalid_values": _invalid("cleaned"),
    "union_by_name": "SELECT * FROM leads UNION ALL BY NAME SELECT * FROM reports",
    "uuid5_key": f"""SELECT lead_number, {_uuid("concat_ws('', " + ", ".join([
        _text("entry_date"), _text("lead_number"), _text("demo", "bool"), _text("appt_date"), "dispo", "job_status",
    ]) + ")")} AS uuid FROM reports""",
    "parse_entry_date_verbatim": "SELECT leadnumber, "
    "make_date(CAST(substr(entrydate, 7) AS INTEGER), 1, CAST(substr(entrydate, 4, 2) AS INTEGER)) AS entry_date "
    "FROM raw_reports",
    "lead_match": """SELECT l.*, r.lead_number, r.appt_date, r.job_status FROM leads l
        LEFT JOIN reports r ON r.phone_hash = l.phone_hash AND r.email_hash = l.email_hash""",
    "dim_date": """SELECT d.*, count(r.appt_date) AS n_appointments FROM d_date d
        LEFT JOIN reports r ON CAST(r.appt_date AS DATE) = d.date_key GROUP BY ALL""",
    "dim_leads": "SELECT * FROM d_leads",
    "dim_places": "SELECT * FROM d_places",
    "dim_status": "SELECT * FROM d_status",
    "fact_kpi": "SELECT * FROM fact",
    "fact_kpi_from_dimensions": "SELECT * FROM fact",
    "kpi_global": _rated("", "fact"),
    "kpi_top_bottom_city": _TOP_BOTTOM,
    "kpi_by_month": _BY_MONTH,
    "kpi_by_status": _BY_STATUS,
    "kpi_by_city_status": _by_city_status("fact"),
    "sql_over_views": """SELECT job_status, count(*) AS leads, count(*) FILTER ("set") AS appointments,
        count(*) FILTER ("set" AND demo) AS demos,
        coalesce(round(count(*) FILTER ("set" AND demo) / nullif(count(*) FILTER ("set"), 0) * 100, 2), 0) AS demo_rate
        FROM fact LEFT JOIN d_status ON d_status.uuid = status_uuid GROUP BY job_status""",
    "row_count": "SELECT count(*) AS n_rows FROM reports",
    "null_counts": "SELECT "
    + ", ".join(f'count(*) - count("{name}") AS "{name}"' for name in _REPORT_COLUMNS)
    + " FROM reports",
    "null_percentages": "SELECT "
    + ", ".join(f'(count(*) - count("{name}")) / nullif(count(*), 0) * 100 AS "{name}"' for name in _REPORT_COLUMNS)
    + " FROM reports",
    "key_audit": """SELECT email_hash, phone_hash, count(DISTINCT lead_uuid) AS unique_lead_uuids,
        count(*) AS total_rows, count(*) - count(lead_uuid) AS null_lead_uuid_count,
        count(lead_uuid) AS non_null_lead_uuid_count FROM leads GROUP BY ALL""",
    "key_audit_reports": """SELECT email_hash, phone_hash, count(DISTINCT lead_number) AS unique_lead_numbers,
        count(*) AS total_rows, count(*) - count(lead_number) AS null_lead_number_count,
        count(lead_number) AS non_null_lead_number_count FROM reports GROUP BY ALL""",
    "key_multiplicity": """SELECT count(*) AS n_keys FROM (SELECT 1 FROM reports GROUP BY email_hash, phone_hash
        HAVING len(list(lead_number) FILTER (WHERE lead_number IS NOT NULL)) > 1)""",
    "csv_snapshots": "SELECT * FROM snapshot_reports",
    "csv_invalid_values": _invalid("cleaned_snapshots"),
    "parquet_leads": "SELECT * FROM leads",
    "parquet_leads_variants": """SELECT CASE WHEN number % 4 = 1 THEN CAST(number AS VARCHAR) ELSE lead_uuid END AS lead_uuid,
        phone_hash, CASE WHEN number % 4 <> 3 THEN email_hash END AS email_hash
        FROM (SELECT *, CAST(substr(lead_uuid, 6) AS INTEGER) AS number FROM leads)""",
    "stored_model_by_city_status": _by_city_status("snapshot_fact"),
    "incremental_reports": "SELECT * FROM snapshot_reports",
    "incremental_invalid_values": _invalid("cleaned_snapshots"),
    "incremental_by_city_status": _by_city_status("snapshot_fact"),
    "incremental_tally": _by_city_status("snapshot_fact"),
    "latest_state": f"""SELECT * FROM reports QUALIFY row_number() OVER (PARTITION BY email_hash, phone_hash
        ORDER BY {", ".join(f'"{name}" DESC NULLS LAST' for name in _STATE_ORDER)}) = 1""",
    "status_changes": """SELECT * EXCLUDE (place) FROM (
        SELECT email_hash, phone_hash, entry_date, lead_number, job_status, lag(job_status) OVER history AS previous_job_status,
               row_number() OVER history AS place
        FROM reports WINDOW history AS (PARTITION BY email_hash, phone_hash
          ORDER BY entry_date NULLS FIRST, lead_number NULLS FIRST, job_status NULLS FIRST))
        WHERE place = 1 OR job_status IS DISTINCT FROM previous_job_status""",
    "reconciled": """SELECT coalesce(l.email_hash, r.email_hash) AS email_hash, coalesce(l.phone_hash, r.phone_hash) AS phone_hash,
        lead_uuid, lead_number, appt_date, job_status, delivered IS NOT NULL AS delivered, reported IS NOT NULL AS reported
        FROM (SELECT *, true AS delivered FROM leads) l FULL JOIN (SELECT *, true AS reported FROM reports) r
        ON r.phone_hash = l.phone_hash AND r.email_hash = l.email_hash""",
    "unmatched_leads": """SELECT * FROM leads l WHERE NOT EXISTS (
        SELECT 1 FROM reports r WHERE r.phone_hash = l.phone_hash AND r.email_hash = l.email_hash)""",
    "unmatched_reports": """SELECT * FROM reports r WHERE NOT EXISTS (
        SELECT 1 FROM leads l WHERE r.phone_hash = l.phone_hash AND r.email_hash = l.email_hash)""",
    "next_report": """SELECT d.*, r.reported_on, r.lead_number, r.job_status FROM raw_deliveries d ASOF LEFT JOIN (
          SELECT phone_hash, email_hash, entry_date AS reported_on, lead_number, job_status FROM reports
          WHERE phone_hash IS NOT NULL AND email_hash IS NOT NULL AND entry_date IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY phone_hash, email_hash, entry_date
                                     ORDER BY lead_number NULLS FIRST, job_status NULLS FIRST) = 1) r
        ON r.phone_hash = d.phone_hash AND r.email_hash = d.email_hash AND r.reported_on >= d.delivered_on""",
}

_LEVEL_COLUMNS = ("state", "city_name", "year", "month", "job_status")


def _level(name: str, rated: str, *columns: str) -> str:
    listed = ", ".join(column if column in columns else f"NULL AS {column}" for column in _LEVEL_COLUMNS)
    return f"""SELECT '{name}' AS level, {listed}, Total_Delivered_Leads, Total_Scheduled_Appointments, Total_Demos, Conversion_Rate,
        Demo_Conversion_Rate FROM ({rated})"""


_ORACLES["kpi_levels"] = "\nUNION ALL\n".join(
    [
        _level("global", _rated("", "fact")),
        _level("city", _BY_CITY, "state", "city_name"),
        _level("month", _BY_MONTH, "year", "month"),
        _level("status", _BY_STATUS, "job_status"),
        _level("city_status", _by_city_status("fact"), "city_name", "job_status"),
    ]
)
_ORACLES["distinct_leads"] = """SELECT city_name, count(DISTINCT lead_uuid) AS Distinct_Leads, true AS close
    FROM fact f LEFT JOIN d_places p ON p.uuid = f.place_uuid GROUP BY city_name"""
_SNAPSHOT_COLUMNS = ", ".join(f'{_squeeze(name)} AS "{header}"' for name, header in HEADERS.items() if name != "dispo")
_OLD, _NEW = (f"(SELECT {_SNAPSHOT_COLUMNS} FROM raw_snapshots WHERE snapshot = 'snapshot-{name}')" for name in "AR")
_ORACLES["snapshot_added"] = f"{_NEW} EXCEPT ALL {_OLD}"
_ORACLES["snapshot_removed"] = f"{_OLD} EXCEPT ALL {_NEW}"
_ORACLES["snapshot_kept"] = f"{_OLD} INTERSECT ALL {_NEW}"

# What is read from skewed raw tables, by query.
_OVER_SKEWED = dict.fromkeys(
    ("lead_match", "dim_leads", "fact_kpi", "latest_state", "status_changes", "reconciled", "next_report"), _SKEWED
) | {"unmatched_leads": _UNREPORTED, "unmatched_reports": _UNREPORTED | _SKEWED_REPORTS}


def oracle_sql() -> dict[str, str]:
    found = {name: _query(select) for name, select in _ORACLES.items()}
    return found | {f"{name}_skewed": _query(_ORACLES[name], **raw) for name, raw in _OVER_SKEWED.items()}
