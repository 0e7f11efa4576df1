"""Kept sums of trips: late trips change their months only, and reports equal a full run."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyline.plans import kpi_reports, kpi_states
from tallyline.session import scratch_path
from tallyline.sources.schemas import TRIP_TABLES


def _trips(seed, size):
    rng = random.Random(seed)
    rows = []
    for i in range(size):
        day = None if rng.random() < 0.03 else dt.date(2024, rng.randint(1, 6), rng.randint(1, 28))
        fare = None if rng.random() < 0.1 else rng.randint(1, 500)
        rows.append((f"t{seed}-{i}", day, rng.choice(["a", "b", "c", None, "x"]), rng.choice(["new", "repeated", None]), None, fare, 1, 1))
    return rows


@pytest.fixture()
def tables(spark):
    cities = spark.createDataFrame([("a", "North"), ("b", "South"), ("c", "North")], "city_id string, city_name string")
    targets = spark.createDataFrame(
        [(dt.date(2024, m, 1), c, 10 * m) for m in range(1, 7) for c in "abc"], "month date, city_id string, total_target_trips int"
    )
    make = lambda rows: spark.createDataFrame(rows, TRIP_TABLES["fact_trips"]).withColumn(
        "distance_travelled_km", F.expr("CAST(pmod(hash(trip_id), 500) / 4 AS DECIMAL(18,2))")
    )
    return make, cities, targets


def _plain(report):
    return Counter(tuple(None if v is None else str(v) for v in row) for row in report.collect())


def test_reports_of_kept_sums_equal_a_full_run(spark, tables):
    make, cities, targets = tables
    path = scratch_path(spark, "sums")
    batches = [_trips(1, 300), _trips(2, 200), [], _trips(3, 1)]
    kept = _fill(make, batches, path)
    full = make([row for batch in batches for row in batch])
    for name, *others in (("city_fare_summary",), ("target_variance", targets), ("peak_month_share",), ("repeat_rate",)):
        got = getattr(kpi_states, name)(kept, cities, *others)
        expected = getattr(kpi_reports, name)(full, cities, *others)
        assert got.columns == expected.columns and _plain(got) == _plain(expected) and got.count()


def _fill(make, batches, path):
    first = make(batches[0])
    kpi_states.create_sums(first, path)
    for batch in batches[1:]:
        kpi_states.add_trips(make(batch), path)
    return kpi_states.read_sums(first.sparkSession, path)


def test_late_trips_change_their_months_only(spark, tables):
    make, _, _ = tables
    path = scratch_path(spark, "sums")
    kpi_states.create_sums(make(_trips(4, 300)), path)
    files = lambda: {f: f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    before = files()
    late = [row for row in _trips(5, 100) if row[1] is None or row[1].month == 3]
    kpi_states.add_trips(make(late), path)
    after = files()
    changed = {f.parent.name for f in set(before.items()) ^ set(after.items()) for f in f[:1]}
    assert changed == {"month=2024-03-01", "month=__HIVE_DEFAULT_PARTITION__"}


def test_only_touched_months_are_read(spark, tables):
    """The other partitions are spoiled."""
    make, _, _ = tables
    path = scratch_path(spark, "sums")
    kpi_states.create_sums(make(_trips(6, 300)), path)
    for file in Path(path).rglob("*.parquet"):
        if file.parent.name != "month=2024-05-01":
            file.write_bytes(b"no parquet")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    kpi_states.add_trips(make([("late", dt.date(2024, 5, 3), "a", "new", None, 7, 1, 1)]), path)
    got = kpi_states.read_sums(spark, path).filter("month = DATE '2024-05-01' AND city_id = 'a'").first()
    assert got.trips == sum(1 for r in _trips(6, 300) if r[1] and r[1].month == 5 and r[2] == "a") + 1
