"""The movement reports on small ledgers with edge rows, with narrow and wide slices and cells."""

from __future__ import annotations

import datetime as dt
import json
from collections import Counter

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tallyline.operators import matching, numbering
from tallyline.operators.legs import legs
from tallyline.plans import ledger_reports as reports
from tallyline.session import scratch_path
from tallyline.sources import sample_tables
from tallyline.sources.readers import as_ledger, read_ledger
from tallyline.sources.schemas import LEDGER

SF_DIR = "/root/testdata/sf0.001"


def _leg(txn, seq, kind, qty, carrier, *, loc="Overstock", dest="OV1", article="21", at="10:00:00", subtype=120, **doc):
    created = dt.datetime.fromisoformat(f"2024-01-05 {at}")
    return (txn, seq, kind, subtype, qty, loc, dest, carrier, article, created, "user", json.dumps(doc))


def _ledger(spark, *lines):
    return as_ledger(spark.createDataFrame(list(lines), LEDGER))


def _dicts(result):
    return [row.asDict() for row in result.collect()]


def test_overstock_rules(spark):
    ledger = _ledger(
        spark,
        _leg("n", 1, 520, -2, "41", REFERENCENUMBER_LHM="R1", SOURCEID_SEKTOR="1", QUALITYID_SEKTOR="2",
             CATEGORYID_ART="5", SKU_ART="own", SORTINGCRITERIAID_ART="s1"),
        _leg("n", 2, 520, 1, "42", dest="anything", SOURCEID_SEKTOR="11", SKU_ART="other"),
        _leg("d", 3, 614, -1, "41", article="91", subtype=None, LASTEANGOTFROMMAUS_ZIEL="29", QUALITYID_SEKTOR=1,
             DISTRIBUTIONCHANNELID_ART="3", SKU_ART="own"),
        _leg("d", 4, 207, 1, "43", DISTRIBUTIONCHANNELID_ART="4", SKU_ART="target", SORTINGCRITERIAID_ART="s2"),
        _leg("d", 5, 207, 1, "0001"),
        _leg("d", 6, 207, 2, "44"),
        _leg("d", 7, 207, 1, "45", dest="SZR"),
        _leg("d", 8, 207, 1, "46", loc="Elsewhere"),
        _leg("d", 9, 207, 1, ""),
        _leg("same", 10, 520, -1, "47"), _leg("same", 11, 520, 1, "47"),
        _leg("unknown", 12, 520, -1, ""), _leg("unknown", 13, 520, 1, "48"),
        _leg("letters", 14, 520, -1, "1"), _leg("letters", 15, 520, 1, "4x"),
        _leg("", 16, 520, -1, "1"), _leg("", 17, 520, 1, "2"),
        _leg(None, 18, 520, -1, "1"), _leg(None, 19, 520, 1, "2"),
    )
    got = {(r["Source_LHM"], r["ZIEL_LHM"]): r for r in _dicts(reports.overstock_report(ledger))}
    assert set(got) == {("41", "42"), ("41", "43"), (None, "48")}
    assert got["41", "42"] == {
        "Timestamp": "05.01.2024 10:00:00", "EAN": "21", "AP": "OV1", "BENUTZER": "user", "Source_LHM": "41",
        "ZIEL_LHM": "42", "Quantity": 2, "Reference_LHM": "R1", "Source_Channel": "OSR (OV)", "Quality": "B",
        "Category": "Beauty", "Distribution_Channel": "Overstock", "SKU": "own", "SORT_ID": "s1",
    }
    assert got["41", "43"] == {
        "Timestamp": "05.01.2024 10:00:00", "EAN": "29", "AP": "OV1", "BENUTZER": "user", "Source_LHM": "41",
        "ZIEL_LHM": "43", "Quantity": 1, "Reference_LHM": None, "Source_Channel": "Unknown", "Quality": "A",
        "Category": "Unknown", "Distribution_Channel": "Outlet", "SKU": "target", "SORT_ID": "s2",
    }


def test_movements_before_completion(spark):
    ledger = _ledger(spark, _leg("n", 1, 520, -1, "41"), _leg("d", 2, 614, -1, "42"))
    assert [r["source_carrier"] for r in _dicts(reports.overstock_movements(ledger))] == ["41"]
    sorting = _ledger(
        spark,
        _leg("n", 1, 520, -1, "41", dest="SZR_OV"),
        _leg("d", 2, 614, -1, "42", dest="IN_SZR_OV"),
        _leg(None, 3, 614, -1, "43", dest="IN_SZR_OV"),
        _leg(None, 4, 207, 1, "44", dest="IN_SZR_OV"),
    )
    got = {(r["source_carrier"], r["target_carrier"]) for r in _dicts(reports.manual_sorting_movements(sorting))}
    assert got == {("41", None), ("42", None), ("43", None)}


def test_manual_sorting_rules(spark):
    ledger = _ledger(
        spark,
        _leg("n", 1, 520, -1, "41", dest="SZR_OV", SOURCEID_SEKTOR="7", DISTRIBUTIONCHANNELID_ART="4", SKU_ART="own"),
        _leg("n", 2, 520, 1, "00042", dest="IN_SZR_OV", SOURCEID_SEKTOR="1", DISTRIBUTIONCHANNELID_ART="3"),
        _leg("d", 3, 614, -1, "51", dest="IN_SZR_OV", article="91", SOURCEID_SEKTOR="11"),
        _leg("d", 4, 614, -1, "52", dest="IN_SZR_OV", article="92", LASTEANGOTFROMMAUS_ZIEL="29"),
        _leg("d", 5, 614, -1, "53", dest="IN_SZR_OV", article="93"),
        _leg("d", 6, 207, 3, "501", dest="SZR_OV", article="27", SKU_ART="first"),
        _leg("d", 7, 207, 1, "62", dest="IN_SZR_OV", article="28", SKU_ART="second"),
        _leg("x", 8, 614, -1, "54", dest="SZR_OV"), _leg("x", 9, 207, 1, "64", dest="SZR_OV"),
        _leg("y", 10, 614, -1, "55", dest="IN_SZR_OV", subtype=110), _leg("y", 11, 207, 1, "65", dest="SZR_OV"),
    )
    fields = ["Source_LHM", "ZIEL_LHM", "EAN", "Source_Channel", "Distribution_Channel", "SKU"]
    expected = {
        ("41", "00042", "21", "Zircle", "Outlet", "own"),
        ("51", "501", "27", "OSR (OV)", "Overstock", "first"),
        ("52", "62", "29", "Zircle", "Unknown", "second"),
    }
    for keep in (False, True):
        kept = reports.sorting_legs(ledger).persist(StorageLevel.MEMORY_AND_DISK) if keep else None
        report = reports.manual_sorting_report(ledger, kept=kept)
        assert {tuple(r[f] for f in fields) for r in _dicts(report)} == expected
        assert ("InMemoryTableScan" in report._jdf.queryExecution().executedPlan().toString()) == keep
    kept.unpersist()


def test_window_before_numbering_and_after_pairing(spark):
    """A transaction across the start of the window: one report still finds its book-in, the other renumbers."""

    def lines(dest):
        return [
            _leg("t", 1, 614, -1, "41", dest=dest, at="09:59:59"),
            _leg("t", 2, 614, -1, "42", dest=dest, at="10:00:00"),
            _leg("t", 3, 207, 1, "61", dest=dest, at="10:00:05"),
            _leg("t", 4, 207, 1, "62", dest=dest, at="10:00:06"),
        ]

    window = ("05.01.2024 10:00:00", "05.01.2024 10:00:05")
    pairs = lambda report: sorted((r["Source_LHM"], r["ZIEL_LHM"]) for r in _dicts(report))
    area, sorting = _ledger(spark, *lines("OV1")), _ledger(spark, *lines("IN_SZR_OV"))
    assert pairs(reports.overstock_report(area)) == [(s, t) for s in ("41", "42") for t in ("61", "62")]
    assert pairs(reports.overstock_report(area, *window)) == [("42", "61"), ("42", "62")]
    assert pairs(reports.manual_sorting_report(sorting)) == [("41", "61"), ("42", "62")]
    assert pairs(reports.manual_sorting_report(sorting, *window)) == [("42", "61")]
    assert pairs(reports.overstock_report(area, window[0], None)) == []


def test_reference_filter_after_numbering(spark):
    legs = [
        _leg("t", 1, 614, -1, "41", dest="IN_SZR_OV", REFERENCENUMBER_LHM="A1"),
        _leg("t", 2, 614, -1, "42", dest="IN_SZR_OV", REFERENCENUMBER_LHM="B1"),
        _leg("t", 3, 207, 1, "61", dest="IN_SZR_OV"),
        _leg("t", 4, 207, 1, "62", dest="IN_SZR_OV"),
    ]
    got = _dicts(reports.manual_sorting_report(_ledger(spark, *legs), reference="b%"))
    assert [(r["Source_LHM"], r["ZIEL_LHM"]) for r in got] == [("42", "62")]


def test_ledger_round_trip_reads_blanks_as_null(spark):
    rows = spark.createDataFrame([_leg("", 1, 520, -1, "", article=" ")], LEDGER)
    path = scratch_path(spark, "ledger")
    rows.write.parquet(path)
    row = read_ledger(spark, path).first()
    assert (row.LOCAL_TRANSACTION_ID, row.LHMNR, row.ARTNR) == (None, None, " ")


@pytest.fixture()
def crowded(spark):
    """The sample ledger with a third of its legs moved into one transaction."""
    ledger = sample_tables.ledger(spark, SF_DIR)
    third = F.when(F.col("SEQUENCE") % 3 == 0, "crowd").otherwise(F.col("LOCAL_TRANSACTION_ID"))
    return ledger.withColumn("LOCAL_TRANSACTION_ID", third)


@pytest.mark.parametrize("divisor", [1, 8])
@pytest.mark.parametrize("arguments", [(), (*entry_points.WINDOW, entry_points.REF_WILDCARD)])
def test_reports_are_the_same_with_any_slices_and_cells(crowded, monkeypatch, arguments, divisor):
    """With unique sequences, and with eight legs on each."""
    ledger = crowded.withColumn("SEQUENCE", F.floor(F.col("SEQUENCE") / divisor))

    def run():
        built = [
            reports.overstock_report(ledger, *arguments),
            reports.manual_sorting_report(ledger, *arguments),
            reports.overstock_movements(ledger, *arguments),
            reports.manual_sorting_movements(ledger, *arguments),
        ]
        return [Counter(map(str, result.collect())) for result in built]

    ordinary = run()
    assert all(ordinary)
    monkeypatch.setattr(numbering, "SLICE_BITS", 4)
    monkeypatch.setattr(matching, "CELL_ROWS", 7)
    assert run() == ordinary


def test_building_a_report_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    ledger = sample_tables.ledger(spark, SF_DIR)
    spark.sparkContext.setJobGroup("building", "building")
    try:
        reports.overstock_report(ledger)
        reports.manual_sorting_report(ledger, *entry_points.WINDOW, entry_points.REF_WILDCARD)
        assert not tracker.getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")


def test_reports_have_native_types(spark):
    ledger = sample_tables.ledger(spark, SF_DIR)
    texts = {"Quantity": "int"}
    for report in (reports.overstock_report(ledger), reports.manual_sorting_report(ledger)):
        assert len(report.dtypes) == 14
        assert all(kind == texts.get(name, "string") for name, kind in report.dtypes)


def test_empty_destination_is_null(spark):
    rows = _ledger(spark, _leg("t", 1, 520, 1, "41", dest=""))
    assert [leg.destination for leg in legs(rows, reports.OVERSTOCK_RULES.normal_in).collect()] == [None]
