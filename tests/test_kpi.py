"""The KPI reports: published figures and edge rows."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyline.operators.aggregates import share_of_total
from tallyline.operators.ranking import best_per_group, fixed_bands, table_preview, top_bottom
from tallyline.plans import kpi_reports as kpi
from tallyline.session import scratch_path
from tallyline.sources.readers import read_csv, read_trip_table, write_csv
from tallyline.sources.schemas import TRIP_TABLES

# New passengers per city over half a year, and repeat passengers by number of trips (2 to 10).
NEW_PASSENGERS = {
    "Jaipur": 45856, "Kochi": 26416, "Chandigarh": 18908, "Lucknow": 16260, "Indore": 14863,
    "Visakhapatnam": 12747, "Mysore": 11681, "Surat": 11626, "Vadodara": 10127, "Coimbatore": 8514,
}
REPEATS = {
    "Chandigarh": [1638, 976, 798, 619, 376, 278, 176, 118, 91],
    "Coimbatore": [286, 378, 397, 526, 450, 267, 157, 59, 31],
    "Indore": [2478, 1637, 967, 746, 494, 378, 235, 172, 109],
    "Jaipur": [4855, 2007, 1173, 609, 400, 244, 184, 116, 94],
    "Kochi": [3635, 1857, 901, 494, 298, 161, 126, 92, 62],
    "Lucknow": [927, 1417, 1555, 1768, 1937, 1087, 617, 183, 106],
    "Mysore": [720, 361, 188, 86, 60, 26, 21, 8, 7],
    "Surat": [843, 1232, 1430, 1706, 1594, 1027, 539, 150, 117],
    "Vadodara": [429, 616, 718, 785, 829, 559, 251, 89, 70],
    "Visakhapatnam": [2618, 1275, 510, 278, 163, 101, 71, 45, 47],
}
REPEAT_PERCENT = {
    "Chandigarh": "32.31 19.25 15.74 12.21 7.42 5.48 3.47 2.33 1.79",
    "Coimbatore": "11.21 14.82 15.56 20.62 17.64 10.47 6.15 2.31 1.22",
    "Indore": "34.34 22.69 13.40 10.34 6.85 5.24 3.26 2.38 1.51",
    "Jaipur": "50.14 20.73 12.12 6.29 4.13 2.52 1.90 1.20 0.97",
    "Kochi": "47.67 24.35 11.81 6.48 3.91 2.11 1.65 1.21 0.81",
    "Lucknow": "9.66 14.77 16.20 18.42 20.18 11.33 6.43 1.91 1.10",
    "Mysore": "48.75 24.44 12.73 5.82 4.06 1.76 1.42 0.54 0.47",
    "Surat": "9.76 14.26 16.55 19.75 18.45 11.89 6.24 1.74 1.35",
    "Vadodara": "9.87 14.17 16.52 18.06 19.08 12.86 5.78 2.05 1.61",
    "Visakhapatnam": "51.25 24.96 9.98 5.44 3.19 1.98 1.39 0.88 0.92",
}
MONTHS = [dt.date(2024, m, 1) for m in range(1, 7)]


def _spread(total: int) -> list[int]:
    """The total over six unequal months."""
    part = total // 21
    return [part * k for k in range(1, 6)] + [total - 15 * part]


def _cities(spark, names=None):
    lines = [(name, name) for name in REPEATS] if names is None else names
    return spark.createDataFrame(lines, TRIP_TABLES["dim_city"])


def _summary(spark, totals):
    lines = [
        (month, city, new, 1, None if new is None else new + 1)
        for city, total in totals.items()
        for month, new in zip(MONTHS, [None] * 6 if total is None else _spread(total))
    ]
    return spark.createDataFrame(lines, TRIP_TABLES["fact_passenger_summary"])


def _trips(spark, lines):
    """Lines: city, date text, passenger type, km, fare."""
    rows = [
        (f"trip{i}", dt.date.fromisoformat(day), city, kind, None if km is None else Decimal(km), fare, 5, 5)
        for i, (city, day, kind, km, fare) in enumerate(lines)
    ]
    return spark.createDataFrame(rows, TRIP_TABLES["fact_trips"])


def _rows(result):
    return [tuple(row) for row in result.collect()]


def test_published_top_and_bottom_cities(spark):
    expected = {(c, NEW_PASSENGERS[c], "Top 3") for c in ("Jaipur", "Kochi", "Chandigarh")}
    expected |= {(c, NEW_PASSENGERS[c], "Bottom 3") for c in ("Surat", "Vadodara", "Coimbatore")}
    summary, cities = _summary(spark, NEW_PASSENGERS), _cities(spark)
    assert set(_rows(kpi.top_bottom_cities(summary, cities))) == expected
    assert set(_rows(kpi.top_bottom_cities_fixed(summary, cities))) == expected


def test_published_repeat_distribution(spark):
    lines = [
        (month, city, f"{n}-Trips", count)
        for city, totals in REPEATS.items()
        for n, total in enumerate(totals, 2)
        for month, count in zip(MONTHS, _spread(total))
    ]
    table = spark.createDataFrame(lines, TRIP_TABLES["dim_repeat_trip_distribution"])
    got = {row[0]: " ".join(map(str, row[1:])) for row in _rows(kpi.repeat_distribution(table, _cities(spark)))}
    assert got == REPEAT_PERCENT


def test_repeat_distribution_edges(spark):
    day = MONTHS[0]
    lines = [
        (day, "a", "2-Trips", 30), (day, "a", "11-Trips", 10),  # outside 2-10: in the denominator only
        (day, "b1", "3-Trips", 1), (day, "b2", "2-Trips", 3),  # two ids of one name
        (day, "c", "2-Trips", 0),
        (day, "nowhere", "2-Trips", 5),
    ]
    table = spark.createDataFrame(lines, TRIP_TABLES["dim_repeat_trip_distribution"])
    cities = _cities(spark, [("a", "A"), ("b1", "B"), ("b2", "B"), ("c", "C")])
    got = {row[0]: row[1:3] for row in _rows(kpi.repeat_distribution(table, cities))}
    assert got == {"A": (Decimal(75), 0), "B": (Decimal(75), Decimal(25)), "C": (None, None)}


def test_fare_summary(spark):
    trips = _trips(
        spark,
        [
            ("a", "2024-01-05", "new", "2.50", 10),
            ("a", "2024-02-05", "new", "0.50", 15),
            ("b", "2024-01-05", "new", "0", 7),
            ("c", "2024-01-05", "new", "4", None),
            ("c", "2024-01-05", "new", "4", 9),
            ("nowhere", "2024-01-05", "new", "1", 1),  # counted in the total only
        ],
    )
    cities = _cities(spark, [("a", "A"), ("b", "B"), ("c", "C"), ("d", "D")])
    assert _rows(kpi.city_fare_summary(trips, cities)) == [
        ("A", 2, Decimal("8.33"), 13, Decimal("33.33")),
        ("C", 2, Decimal("1.13"), 9, Decimal("33.33")),
        ("B", 1, None, 7, Decimal("16.67")),
    ]


def test_target_variance_edges(spark):
    trips = _trips(
        spark,
        [("a", "2024-09-05", "new", "1", 1)] * 3
        + [("a", "2024-05-31", "new", "1", 1)] * 2
        + [("b", "2024-05-01", "new", "1", 1)] * 2
        + [("c", "2024-05-01", "new", "1", 1)],  # no target
    )
    targets = spark.createDataFrame(
        [
            (dt.date(2024, 9, 1), "a", 2),
            (dt.date(2024, 5, 1), "a", 2),
            (dt.date(2024, 5, 1), "b", 0),
            (dt.date(2024, 6, 1), "b", 7),  # no trips
        ],
        TRIP_TABLES["monthly_target_trips"],
    )
    cities = _cities(spark, [("a", "A"), ("b", "B"), ("c", "C")])
    assert _rows(kpi.target_variance(trips, cities, targets)) == [
        ("A", "May      ", 2, 2, "Below Target", Decimal(0)),
        ("A", "September", 3, 2, "Above Target", Decimal(50)),
        ("B", "May      ", 2, 0, "Above Target", None),
    ]
    fewer = spark.createDataFrame([(dt.date(2024, 9, 1), "a", 7)], TRIP_TABLES["monthly_target_trips"])
    assert _rows(kpi.target_variance(trips, cities, fewer)) == [
        ("A", "September", 3, 7, "Below Target", Decimal("-57.14"))
    ]


def test_a_city_id_listed_twice_counts_as_the_joins_do(spark):
    trips = _trips(spark, [("a", "2024-05-05", "new", "1", 4)])
    cities = _cities(spark, [("a", "A"), ("a", "A")])
    targets = spark.createDataFrame([(dt.date(2024, 5, 1), "a", 2)], TRIP_TABLES["monthly_target_trips"])
    assert _rows(kpi.target_variance(trips, cities, targets)) == [("A", "May      ", 2, 2, "Below Target", Decimal(0))]
    table = spark.createDataFrame([(MONTHS[0], "a", "2-Trips", 3)], TRIP_TABLES["dim_repeat_trip_distribution"])
    assert _rows(kpi.repeat_distribution(table, cities))[0][1] == Decimal(200)


def _totals(spark, values):
    return spark.createDataFrame([(f"g{i}", v) for i, v in enumerate(values)], "name string, total long")


def _bands(result):
    return sorted(((r.category, r.total) for r in result.collect()), key=str)


@pytest.mark.parametrize(
    "values, top, bottom",
    [
        ([9, 8, 7, 6, 5, 4, 3, 2, 1], [9, 8, 7], [3, 2, 1]),
        ([9, 8, 7, 7, 7, 3, 3, 2, 1], [9, 8, 7, 7, 7], [3, 3, 2, 1]),
        ([5, 5, 5, 5, 1, 1, 1, 1], [5] * 4, [1] * 4),
        ([4, 3, 2, 1], [4, 3, 2], [1]),
        ([2, 1], [2, 1], []),
        ([None, None, 5, 4, 3, 2, 1], [None, None, 5], [3, 2, 1]),
        ([None, None, None, None, 2, 1, 0], [None] * 4, [2, 1, 0]),
    ],
)
def test_top_and_bottom_bands(spark, values, top, bottom):
    expected = [("Top 3", v) for v in top] + [("Bottom 3", v) for v in bottom]
    assert _bands(top_bottom(_totals(spark, values), "total", 3)) == sorted(expected, key=str)


@pytest.mark.parametrize(
    "values, top, bottom",
    [
        (list(range(12, 0, -1)), [12, 11, 10], [5, 4, 3]),  # twelve groups: ranks 8 to 10 are not the last
        (list(range(9, 0, -1)), [9, 8, 7], [2, 1]),
        ([9, 8, 7, 7, 5, 4, 3, 2, 1, 0], [9, 8, 7, 7], [2, 1, 0]),
        ([9, 8, 7, 6, 5, 4, 2, 2, 2, 2], [9, 8, 7], []),  # four groups of rank 7
        ([None, None, 9, 8, 7, 6, 5, 4, 3, 3], [None, None, 9], [4, 3, 3]),
        ([5] * 12, [5] * 12, []),
    ],
)
def test_fixed_bands_as_written(spark, values, top, bottom):
    expected = [("Top 3", v) for v in top] + [("Bottom 3", v) for v in bottom]
    assert _bands(fixed_bands(_totals(spark, values), "total")) == sorted(expected, key=str)


@pytest.mark.parametrize("seed", range(6))
def test_random_bands_equal_ranks(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([None, *range(rng.choice([3, 40]))]) for _ in range(rng.randrange(1, 40))]
    key = lambda v: (v is None, v or 0)
    down = lambda v: 1 + sum(key(w) > key(v) for w in values)
    up = lambda v: 1 + sum(key(w) < key(v) for w in values)
    general = [("Top 3", v) if down(v) <= 3 else ("Bottom 3", v) for v in values if down(v) <= 3 or up(v) <= 3]
    fixed = [("Top 3", v) if down(v) <= 3 else ("Bottom 3", v) for v in values if down(v) in (1, 2, 3, 8, 9, 10)]
    assert _bands(top_bottom(_totals(spark, values), "total", 3)) == sorted(general, key=str)
    assert _bands(fixed_bands(_totals(spark, values), "total")) == sorted(fixed, key=str)


def test_peak_month(spark):
    trips = _trips(
        spark,
        [
            ("a", "2024-01-05", "new", "1", 10), ("a", "2024-02-05", "new", "1", 20), ("a", "2024-02-06", "new", "1", 5),
            ("b", "2024-03-05", "new", "1", 4), ("b", "2024-04-05", "new", "1", 4), ("b", "2025-04-05", "new", "1", 1),
            ("c", "2024-05-05", "new", "1", 3),
        ],
    )
    cities = _cities(spark, [("a", "A"), ("b", "B"), ("c", "C")])
    assert _rows(kpi.peak_month_share(trips, cities)) == [
        ("A", "February", 25, Decimal("71.43")),
        ("B", "March", 4, Decimal("44.44")),
        ("B", "April", 4, Decimal("44.44")),
        ("C", "May", 3, Decimal(100)),
    ]
    assert [r[3] for r in _rows(kpi.peak_month_share_int(trips, cities))] == [0, 0, 0, 100]


def test_repeat_rate(spark):
    trips = _trips(
        spark,
        [("a", "2024-05-05", "repeated", "1", 1)]
        + [("a", "2024-05-05", "new", "1", 1)] * 2
        + [("a", "2023-09-05", None, "1", 1)]
        + [("b", "2024-05-05", "repeated", "1", 1)],
    )
    cities = _cities(spark, [("a", "A"), ("b", "A2")])
    assert _rows(kpi.repeat_rate(trips, cities)) == [
        ("A", "September", 1, 0, Decimal(0), Decimal(25)),
        ("A", "May      ", 3, 1, Decimal("33.33"), Decimal(25)),
        ("A2", "May      ", 1, 1, Decimal(100), Decimal(100)),
    ]


def test_shares_without_orphans_sum_to_one_hundred(spark):
    rows = spark.range(1000).select((F.col("id") % 8).alias("g"))
    assert share_of_total(rows, "g").agg(F.sum("percentage")).first()[0] == 100


def test_best_per_group_keeps_ties_and_prefers_null(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 3), ("a", 3), ("b", 2), ("b", None)], "g string, v long")
    assert sorted(_rows(best_per_group(rows, ["g"], "v")), key=str) == [("a", 3), ("a", 3), ("b", None)]


def test_preview(spark):
    rows = spark.range(100, numPartitions=7).select((F.col("id") % 50).alias("v"))
    assert [r.v for r in table_preview(rows, 5, ["v"]).collect()] == [0, 0, 1, 1, 2]
    assert table_preview(rows).count() == 100


def test_csv_round_trip_and_readers(spark):
    trips = _trips(spark, [("a", "2024-01-05", "new", "2.50", 10), ("b", "2024-01-06", "repeated", "1.00", 3)])
    path = scratch_path(spark, "trips")
    write_csv(trips, path)
    assert read_csv(spark, path, TRIP_TABLES["fact_trips"]).schema.simpleString() == trips.schema.simpleString()
    assert sorted(_rows(read_trip_table(spark, "fact_trips", path, "csv"))) == sorted(_rows(trips))
    parquet = scratch_path(spark, "trips")
    trips.write.parquet(parquet)
    assert sorted(_rows(read_trip_table(spark, "fact_trips", parquet))) == sorted(_rows(trips))


def test_csv_that_does_not_fit_fails(spark):
    path = scratch_path(spark, "bad")
    spark.createDataFrame([("x", "A"), ("y", "B")], "city_id string, target_avg_passenger_rating string").write.option(
        "header", True
    ).csv(path)
    with pytest.raises(Exception, match="MALFORMED|cannot|FAILFAST"):
        read_trip_table(spark, "city_target_passenger_rating", path, "csv").collect()
