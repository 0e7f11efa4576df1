"""The reports as SQL table functions against the reports as DataFrames."""

from __future__ import annotations

from collections import Counter

import pytest

import __spark_entry__ as entry_points
from tallyline.plans import ledger_reports, sql_functions
from tallyline.session import scratch_path
from tallyline.sources import sample_tables
from tallyline.sources.readers import read_ledger

SF_DIR = "/root/testdata/sf0.001"
NAMES = ("start_datetime", "end_datetime", "ref_lhm_filter")
START, END = entry_points.WINDOW


@pytest.fixture(scope="module")
def ledger(spark):
    path = scratch_path(spark, "ledger")
    sample_tables.ledger(spark, SF_DIR).write.parquet(path)
    rows = read_ledger(spark, path)
    sql_functions.register_reports(rows)
    return rows


def _call(name, arguments):
    given = {n: a for n, a in zip(NAMES, arguments) if a is not ...}
    return f"SELECT * FROM {name}({', '.join(f'{n} => ' + ('NULL' if a is None else repr(a)) for n, a in given.items())})"


@pytest.mark.parametrize(
    "arguments",
    [
        (..., ..., ...), (START, END, ...), (START, END, "ref1%"), (None, None, "REF12,ref7,REF31"), (..., ..., "ref7"), (..., ..., "ref_"),
        (START, None, ...), (None, END, ...), ("", "", ""), (..., ..., "REF_1,REF%,x"),
    ],
)
@pytest.mark.parametrize("name", ["overstock_report", "manual_sorting_report"])
def test_functions_equal_dataframes(spark, ledger, name, arguments):
    got = spark.sql(_call(name, arguments))
    expected = getattr(ledger_reports, name)(ledger, *[None if a is ... else a for a in arguments])
    assert got.dtypes == expected.dtypes
    assert Counter(got.collect()) == Counter(expected.collect())


@pytest.mark.parametrize("name", ["overstock_report", "manual_sorting_report"])
def test_parameters_that_are_null_leave_no_condition(spark, ledger, name):
    plan = lambda *arguments: spark.sql(_call(name, arguments))._jdf.queryExecution().optimizedPlan().toString()
    assert not any(word in plan(None, None, None) for word in ("instr", " LIKE ", "2024-01-05"))
    assert "2024-01-05" in plan(START, END, None)
    assert "instr" not in plan(None, None, "ref1%") and " LIKE " in plan(None, None, "ref1%").replace("StartsWith", " LIKE ")


def test_a_function_scans_the_ledger_once(spark, ledger):
    for name in ("overstock_report", "manual_sorting_report"):
        result = spark.sql(_call(name, (START, END, "ref1%")))
        result.collect()
        plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("FileScan parquet") == 1 and plan.count("ReusedExchange") == 1
