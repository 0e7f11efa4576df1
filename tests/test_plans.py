"""The shape of the plans: what must hold at any scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tallyline.operators.pairing import pair_by_sequence
from tallyline.operators.ranking import table_preview
from tallyline.plans import kpi_reports, ledger_reports
from tallyline.session import scratch_path
from tallyline.sources import sample_tables
from tallyline.sources.readers import read_ledger, read_trip_table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def long_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def _plan(result) -> str:
    return result._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_small_tables(spark):
    """Plans as they are for tables beyond the broadcast limit."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def ledger_path(spark):
    path = scratch_path(spark, "ledger")
    sample_tables.ledger(spark, SF_DIR).write.parquet(path)
    return path


@pytest.mark.parametrize("name", sorted(entry_points._registered()))
def test_no_python_and_no_cross_join(spark, name):
    plan = _plan(entry_points.queries()[name](spark, SF_DIR))
    for word in ("Python", "CartesianProduct", "NestedLoop", "ExistingRDD"):
        assert word not in plan, word


@pytest.mark.parametrize(
    "name, exchanges",
    # The legs by cell, shown twice and run once; sizes of cells by key, and back; meetings. Sequence numbers: legs by slice,
    # sizes of slices: counted, by transaction, and back.
    [("overstock_report", 2 + 2 + 1), ("sequence_number", 1 + 3), ("pair_by_sequence", 2 + 2 + 1)],
)
def test_shuffles_of_a_leg_set(no_small_tables, name, exchanges):
    plan = _plan(entry_points.queries()[name](no_small_tables, SF_DIR))
    assert plan.count("Exchange hashpartitioning") == exchanges


def _executed(result) -> str:
    """The plan as it ran, after the reuse of exchanges."""
    result.collect()
    return _plan(result).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("broadcasts", [True, False])
@pytest.mark.parametrize("arguments", [(), (*entry_points.WINDOW, entry_points.REF_WILDCARD)])
@pytest.mark.parametrize("report", [ledger_reports.overstock_report, ledger_reports.manual_sorting_report])
def test_a_report_scans_the_ledger_once(spark, ledger_path, report, arguments, broadcasts):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20) if broadcasts else "-1")
    try:
        plan = _executed(report(read_ledger(spark, ledger_path), *arguments))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan parquet") == 1
    assert plan.count("ReusedExchange") == 1
    assert plan.count("Generate json_tuple") == 1


def test_leg_filters_reach_the_scan(no_small_tables, ledger_path):
    ledger = read_ledger(no_small_tables, ledger_path)
    report = ledger_reports.manual_sorting_report(ledger, "05.01.2024 00:00:00", "06.01.2024 00:00:00")
    pushed = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", _plan(report))
    assert pushed
    assert all("TPARTNR" in p and "MENGE" in p and "CREATED" in p and "ZIEL" in p for p in pushed)


def test_document_is_parsed_by_one_generator(no_small_tables, ledger_path):
    plan = _plan(ledger_reports.overstock_report(read_ledger(no_small_tables, ledger_path), reference="ref%"))
    assert plan.count("Generate json_tuple") == 1
    assert "get_json_object" not in plan and "from_json" not in plan


def test_facts_are_aggregated_before_the_join(no_small_tables):
    trips, cities = sample_tables.fact_trips(no_small_tables, SF_DIR), sample_tables.dim_city(no_small_tables, SF_DIR)
    for report in (kpi_reports.city_fare_summary, kpi_reports.repeat_rate, kpi_reports.peak_month_share):
        plan = _plan(report(trips, cities))
        lines = plan.splitlines()
        scan = max(i for i, line in enumerate(lines) if "l_partkey" in line and "FileScan" in line)
        above = [line for line in lines[:scan] if "HashAggregate" in line or "Join" in line]
        assert "HashAggregate" in above[-1] and "partial" in above[-1]


def test_fact_scan_reads_needed_columns_only(spark):
    path = scratch_path(spark, "trips")
    sample_tables.fact_trips(spark, SF_DIR).write.parquet(path)
    trips, cities = read_trip_table(spark, "fact_trips", path), sample_tables.dim_city(spark, SF_DIR)
    plan = _plan(kpi_reports.city_fare_summary(trips, cities))
    schemas = set(re.findall(r"ReadSchema: (struct<.*?>)", plan))
    assert "struct<city_id:string,distance_travelled_km:decimal(18,2),fare_amount:int>" in schemas
    assert schemas <= {"struct<city_id:string,distance_travelled_km:decimal(18,2),fare_amount:int>", "struct<n_nationkey:bigint,n_name:string>", "struct<n_nationkey:int,n_name:string>"}


def test_preview_reads_no_more_than_it_needs(spark):
    trips = sample_tables.fact_trips(spark, SF_DIR)
    assert not any(word in _plan(table_preview(trips, 10)) for word in ("Sort", "TakeOrdered", "Exchange hash"))
    assert table_preview(trips, 10).count() == 10


@pytest.mark.parametrize("name", ["city_fare_summary", "share_of_total"])
def test_the_total_comes_from_the_counts(spark, name):
    result = entry_points._registered()[name](spark, SF_DIR)
    result.collect()
    final = _plan(result).split("== Initial Plan ==")[0]
    scans = re.findall(r"FileScan parquet \[.*l_partkey", final)
    assert len(scans) == 1 or "Reused" in final


def test_rank_filters_limit_before_the_window(spark):
    assert "WindowGroupLimit" in _plan(entry_points.queries()["peak_month_share"](spark, SF_DIR))
    for name in ("top_bottom_groups", "top_bottom_fixed_bands"):
        plan = _plan(entry_points.queries()[name](spark, SF_DIR))
        assert "TakeOrderedAndProject" in plan
        assert "Window [rank" not in plan


def test_a_group_is_numbered_in_slices(no_small_tables):
    spark = no_small_tables
    legs = spark.range(4000).select(
        F.lit("hot").alias("txn"),
        F.when(F.col("id") % 2 == 0, "OUT").otherwise("IN").alias("side"),
        (F.col("id") * 4096).alias("seq"),
        F.col("id").alias("source"),
        F.col("id").alias("target"),
    )
    pairs = pair_by_sequence(legs, ["txn"], "seq", out_columns=["source"], in_columns=["target"])
    plan = _plan(pairs)
    assert re.search(r"Exchange hashpartitioning\(_cell#\d+", plan)
    assert re.search(r"Exchange hashpartitioning\(_meeting#\d+", plan)
    assert pairs.filter("target = source + 1").count() == 2000
