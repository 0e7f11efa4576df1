"""Ledgers by day and by transaction: the same rows, and what is neither read nor shuffled."""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tallyline.functions.calendar import DAY_COLUMN
from tallyline.operators.legs import legs, window_filter
from tallyline.operators.pairing import pair_bucketed_by_sequence, pair_by_sequence
from tallyline.plans import ledger_reports as reports
from tallyline.session import scratch_path
from tallyline.sources import layouts, sample_tables

SF_DIR = "/root/testdata/sf0.001"


def _plan(result) -> str:
    return result._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def by_day(spark):
    path = scratch_path(spark, "by-day")
    ledger = sample_tables.ledger(spark, SF_DIR).withColumn("CREATED", F.expr("IF(SEQUENCE % 101 = 0, NULL, CREATED)"))
    layouts.write_ledger_by_day(ledger, path)
    return path, ledger


def test_the_ledger_by_day_has_the_same_rows(spark, by_day):
    path, ledger = by_day
    got = layouts.read_ledger_by_day(spark, path).drop(DAY_COLUMN)
    assert got.dtypes == ledger.dtypes
    assert Counter(map(str, got.collect())) == Counter(map(str, ledger.collect()))


@pytest.mark.parametrize("window", [entry_points.WINDOW, ("05.01.2024 00:00:00", None), (None, "05.01.2024 00:00:00"), ("09.01.2024 23:59:59", "10.01.2024 00:00:00")])
def test_windows_by_day(spark, by_day, window):
    path, ledger = by_day
    got = window_filter(layouts.read_ledger_by_day(spark, path), "CREATED", *window).drop(DAY_COLUMN)
    assert Counter(map(str, got.collect())) == Counter(map(str, window_filter(ledger, "CREATED", *window).collect()))


def test_files_outside_the_window_are_not_read(spark, by_day):
    """They are spoiled: reading one would fail."""
    _, ledger = by_day
    path = scratch_path(spark, "spoiled")
    layouts.write_ledger_by_day(ledger, path)
    spoiled = [f for f in Path(path).rglob("*.parquet") if not "2024-01-05" <= f.parent.name.rsplit("=")[-1] <= "2024-01-21"]
    assert spoiled
    for file in spoiled:
        file.write_bytes(b"no parquet")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    report = reports.manual_sorting_report(layouts.read_ledger_by_day(spark, path), *entry_points.WINDOW)
    expected = reports.manual_sorting_report(ledger, *entry_points.WINDOW)
    assert Counter(map(str, report.collect())) == Counter(map(str, expected.collect()))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", _plan(report))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert filters and all(f"{DAY_COLUMN}" in f and ">=" in f and "<=" in f for f in filters)


_COLUMNS = {"out_columns": ["created", "source"], "in_columns": ["target", "article"]}


def _strict_legs(ledger):
    rules = reports.MANUAL_SORTING_RULES
    return legs(ledger, rules.dummy_out, rules.dummy_in).withColumns({"source": F.col("carrier"), "target": F.col("carrier")})


@pytest.mark.parametrize("keep", [True, False])
@pytest.mark.parametrize("heavy_legs", [4, 10**6])
def test_pairs_of_the_bucketed_ledger(spark, keep, heavy_legs):
    ledger = sample_tables.ledger(spark, SF_DIR).withColumn(
        "LOCAL_TRANSACTION_ID", F.expr("IF(SEQUENCE % 3 = 0, 'crowd', IF(SEQUENCE % 50 = 1, NULL, LOCAL_TRANSACTION_ID))")
    )
    bucketed = layouts.write_bucketed_ledger(ledger, scratch_path(spark, "buckets"), 5, heavy_legs)
    assert (bucketed.heavy is not None) == (heavy_legs == 4)
    parts = [bucketed.light, bucketed.unknown, *([bucketed.heavy] if bucketed.heavy is not None else [])]
    assert Counter(str(r) for part in parts for r in part.collect()) == Counter(map(str, ledger.collect()))
    got = pair_bucketed_by_sequence(bucketed, _strict_legs, ["txn"], "sequence", **_COLUMNS, keep_unmatched=keep)
    expected = pair_by_sequence(_strict_legs(ledger), ["txn"], "sequence", **_COLUMNS, keep_unmatched=keep)
    assert Counter(map(str, got.collect())) == Counter(map(str, expected.collect()))


def test_the_bucketed_ledger_is_not_shuffled(spark):
    path = scratch_path(spark, "buckets")
    written = layouts.write_bucketed_ledger(sample_tables.ledger(spark, SF_DIR), path, 8)
    for bucketed in (written, layouts.read_bucketed_ledger(spark, path, 8)):
        plan = _plan(pair_bucketed_by_sequence(bucketed, _strict_legs, ["txn"], "sequence", **_COLUMNS))
        assert "Exchange" not in plan and "Bucketed: true" in plan
