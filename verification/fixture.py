"""Raw leads and reports, derived from the test tables by SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.functions import quoted

TABLES = ("customer", "lineitem", "nation", "orders")

RAW_LEADS = """
SELECT concat('lead-', CAST(c_custkey AS STRING)) AS lead_UUID,
       md5(concat('p', CAST(c_custkey AS STRING))) AS phone_hash,
       md5(concat('e', CAST(c_custkey AS STRING))) AS email_hash
FROM {customer}
"""

# Every thirtieth lead has the contact of lead 0, which no report has otherwise.
SKEWED_LEADS = """
SELECT concat('lead-', CAST(c_custkey AS STRING)) AS lead_UUID,
       md5(concat('p', CAST(CASE WHEN c_custkey % 30 = 0 THEN 0 ELSE c_custkey END AS STRING))) AS phone_hash,
       md5(concat('e', CAST(CASE WHEN c_custkey % 30 = 0 THEN 0 ELSE c_custkey END AS STRING))) AS email_hash
FROM {customer}
"""

# Every thirtieth lead has a contact that no report has; then lead 0's contact, which skewed reports have, is that of no lead.
UNREPORTED_LEADS = SKEWED_LEADS.replace("THEN 0 ELSE", "THEN -1 ELSE")

_REPORT_COLUMNS = """
 concat(lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '/', lpad(CAST(day(o_orderdate) AS STRING), 2, '0'), '/',
        CAST(year(o_orderdate) AS STRING)) AS entrydate,
 CASE WHEN o_orderkey % 97 = 0 THEN 'N/A' ELSE CAST(o_orderkey AS STRING) END AS leadnumber,
 CASE WHEN o_orderkey % 10 = 0 THEN '-----' ELSE md5(concat('p', CAST(o_custkey AS STRING))) END AS phone_hash,
 CASE WHEN o_orderkey % 10 = 0 THEN '-----' ELSE md5(concat('e', CAST(o_custkey AS STRING))) END AS email_hash,
 CASE WHEN o_orderkey % 41 = 0 THEN '7' ELSE substr(c_mktsegment, 1, 2) END AS state,
 concat(lpad(CAST(c_nationkey * 1000 + c_custkey % 7 AS STRING), 5, '0'),
        CASE WHEN o_orderkey % 53 = 0 THEN '-1234' ELSE '' END) AS zip,
 CASE WHEN o_orderstatus = 'O' THEN CAST(NULL AS STRING)
      ELSE concat(CAST(month(o_orderdate) AS STRING), '/', lpad(CAST(day(o_orderdate) AS STRING), 2, '0'), '/',
                  CAST(year(o_orderdate) AS STRING), ' ', CAST(o_orderkey % 12 + 1 AS STRING), ':30',
                  CASE WHEN o_orderkey % 2 = 0 THEN 'AM' ELSE 'PM' END) END AS appt_date_raw,
 CASE WHEN o_orderstatus = 'F' THEN 'TRUE' WHEN o_orderstatus = 'P' THEN '0' ELSE 'maybe' END AS demo,
 CASE WHEN o_orderstatus = 'O' THEN 'false' ELSE '1' END AS set_raw,
 concat('  ', c_mktsegment, '   lead ') AS dispo,
 CASE WHEN o_orderkey % 17 = 0 THEN '-----' ELSE o_orderpriority END AS job_status_raw,
 n_name AS cityname
"""

RAW_REPORTS = f"""
SELECT {_REPORT_COLUMNS}
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey
"""

# Every tenth customer's reports have the contact of lead 0.
SKEWED_REPORTS = RAW_REPORTS.replace(
    "CAST(o_custkey AS STRING)", "CAST(CASE WHEN o_custkey % 10 = 0 THEN 0 ELSE o_custkey END AS STRING)"
)

_SNAPSHOT_COLUMNS = f"""concat('snapshot-', l_returnflag) AS snapshot, {_REPORT_COLUMNS.replace(
    "concat('  ', c_mktsegment, '   lead ')",
    "concat(c_mktsegment, repeat(' ', CAST(l_linenumber AS INT)), 'lead ')")}"""

_SNAPSHOT_TABLES = """{lineitem} JOIN {orders} ON l_orderkey = o_orderkey
JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
"""

# Three report snapshots with copies: an order occurs once per line item, in the snapshot of its return flag. Copies
# differ in whitespace only.
RAW_SNAPSHOTS = f"""
SELECT {_SNAPSHOT_COLUMNS}
FROM {_SNAPSHOT_TABLES}"""

# The same rows before their texts are made, a fifth of the bytes: the columns that the texts are made of.
SNAPSHOT_LINES = f"""
SELECT l_returnflag, l_linenumber, o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_orderpriority,
       c_mktsegment, c_nationkey, n_name
FROM {_SNAPSHOT_TABLES}"""

# Columns of lines that agree wherever the raw rows do, but for whitespace: each follows from a column of the raw row.
COPIES_SHARE = (
    "CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey END",
    "CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END",
    "CAST(o_orderdate AS DATE)",
    "n_name",
)

# A delivery of a lead per line item, on its shipping date.
RAW_DELIVERIES = """
SELECT concat('lead-', CAST(o_custkey AS STRING)) AS lead_uuid,
       md5(concat('p', CAST(o_custkey AS STRING))) AS phone_hash,
       md5(concat('e', CAST(o_custkey AS STRING))) AS email_hash,
       CAST(l_shipdate AS DATE) AS delivered_on
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

# Every tenth customer's leads have the contact of lead 0, and half of these deliveries one date.
SKEWED_DELIVERIES = """
SELECT concat('lead-', CAST(o_custkey AS STRING)) AS lead_uuid,
       md5(concat('p', CAST(CASE WHEN o_custkey % 10 = 0 THEN 0 ELSE o_custkey END AS STRING))) AS phone_hash,
       md5(concat('e', CAST(CASE WHEN o_custkey % 10 = 0 THEN 0 ELSE o_custkey END AS STRING))) AS email_hash,
       CASE WHEN o_custkey % 20 = 0 THEN DATE '1995-06-17' ELSE CAST(l_shipdate AS DATE) END AS delivered_on
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

# SQL names -> headers of a real report.
HEADERS = {
    "entrydate": "ENTRYDATE",
    "leadnumber": "LEADNUMBER",
    "phone_hash": "phone_hash",
    "email_hash": "email_hash",
    "state": "STATE",
    "zip": "ZIP",
    "appt_date_raw": "Appt Date",
    "demo": "Demo",
    "set_raw": "Set",
    "dispo": "Dispo",
    "job_status_raw": "Job Status",
    "cityname": "CityName",
}


def raw_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, RAW_LEADS)


def skewed_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, SKEWED_LEADS)


def unreported_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, UNREPORTED_LEADS)


def skewed_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_headers(_run(spark, sf_dir, SKEWED_REPORTS))


def raw_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, RAW_DELIVERIES)


def skewed_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, SKEWED_DELIVERIES)


def raw_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_headers(_run(spark, sf_dir, RAW_REPORTS))


def raw_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_headers(_run(spark, sf_dir, RAW_SNAPSHOTS))


def snapshot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What :func:`raw_snapshots` makes its rows of, a line each; :func:`snapshots_of` makes them."""
    return _run(spark, sf_dir, SNAPSHOT_LINES)


def snapshots_of(lines: DataFrame) -> DataFrame:
    lines = lines.withColumn("c_custkey", F.col("o_custkey"))  # joined on it
    return _with_headers(lines.sparkSession.sql(f"SELECT {_SNAPSHOT_COLUMNS} FROM {{lines}}", lines=lines))


def _run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = [name for name in TABLES if "{" + name + "}" in sql]
    return spark.sql(sql, **{name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in used})


def _with_headers(df: DataFrame) -> DataFrame:
    return df.select([quoted(name).alias(HEADERS.get(name, name)) for name in df.columns])
