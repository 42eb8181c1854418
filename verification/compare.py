"""Compare all rows of a Spark answer with those of the SQL in DuckDB."""

from __future__ import annotations

import datetime
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from verification.oracles import oracle_sql

TABLES = "region nation customer supplier part orders lineitem events".split()


def differences(actual: DataFrame, sf_dir: str, name: str) -> str | None:
    """What differs between the answer to query ``name`` and that of its SQL; None if nothing does."""
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    expected = connection.sql(oracle_sql()[name]).to_arrow_table()
    wanted = {column: _kind(str(kind)) for column, kind in zip(expected.column_names, expected.schema.types)}
    found = {column: _kind(kind) for column, kind in actual.dtypes}
    if wanted != found:
        return f"columns {found}, expected {wanted}"
    columns = sorted(wanted)
    rows = Counter(tuple(_value(row[c]) for c in columns) for row in expected.to_pylist())
    spark_rows = Counter(tuple(_value(row[c]) for c in columns) for row in actual.collect())
    if rows == spark_rows:
        return None
    missing, extra = rows - spark_rows, spark_rows - rows
    return (
        f"{rows.total()} rows expected, {spark_rows.total()} found; columns {columns}; "
        f"missing {missing.total()} such as {list(missing)[:2]}; extra {extra.total()} such as {list(extra)[:2]}"
    )


def _kind(name: str) -> str:
    names = {"large_string": "string", "int32": "int", "int64": "bigint", "bool": "boolean", "date32[day]": "date"}
    return names.get(name, "timestamp" if name.startswith("timestamp") else name)


def _value(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value
