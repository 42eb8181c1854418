"""Registered queries against their SQL, over whole tables."""

from collections import Counter

import duckdb
import pytest

from funnelwright.llm.oracles import oracle_sql
from funnelwright.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    expected = connection.sql(oracle_sql()[name]).to_arrow_table()
    actual = QUERIES[name](spark, SF)
    assert sorted(actual.columns) == sorted(expected.column_names)
    columns = sorted(actual.columns)
    rows = Counter(tuple(row[c] for c in columns) for row in expected.to_pylist())
    assert Counter(tuple(row[c] for c in columns) for row in actual.collect()) == rows


def test_native_queries_run_no_python(spark):
    for name in ("op1_mix", "op4_leaks", "op8_shards"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
