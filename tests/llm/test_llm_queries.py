"""Registered queries with a SQL twin, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from tallyline.llm import queries
from twins import compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_twin(spark, con, name):
    own_columns, twin_columns, own, twin = compare(queries.queries()[name](spark, SF_DIR), con, queries.oracle_sql()[name])
    assert own_columns == twin_columns
    assert own == twin
    assert own


NATIVE = ("op1_secret_scans", "op4_source_mix")


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, name):
    plan = queries.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExistingRDD", "CartesianProduct"))
