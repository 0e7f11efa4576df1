"""Lookups in tables, ranks of any number of rows, CSV files with bad lines, parsed documents."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import Window, functions as F

from tallyline.functions import codes
from tallyline.functions.json_fields import sound_variant, with_json_fields, with_variant_fields
from tallyline.functions.text import reference_predicate
from tallyline.operators import numbering
from tallyline.operators.lookups import decode_by_table, ref_filter_by_table
from tallyline.operators.numbering import sequence_number, sliced
from tallyline.operators.ranking import global_rank
from tallyline.session import scratch_path
from tallyline.sources.readers import read_csv_checked
from tallyline.sources.schemas import TRIP_TABLES

RAW = "i long, ref string"


def _plan(result) -> str:
    return result._jdf.queryExecution().executedPlan().toString()


# --- codes ------------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [0, 100])
def test_a_table_of_codes_gives_the_rows_of_decode(spark, limit):
    labels = {"1": "it's one", "2": None, None: "none", "": "empty", "a\\b": "slash"}
    pairs = [(i, k, v) for i, (k, v) in enumerate(labels.items())] + [(90, "1", "again"), (91, "2", "late"), (92, None, "late")]
    table = spark.createDataFrame(pairs[::-1], "position int, code string, label string")
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(["1", "2", None, "", "3", "a\\b", "1"])], "i int, _known string")
    for default in ("x'y\\z", None):
        got = decode_by_table(rows, "_known", table, default=default, name="label", broadcast_codes=limit)
        expected = rows.withColumn("label", codes.decode_codes(F.col("_known"), labels, default))
        assert got.columns == expected.columns and Counter(got.collect()) == Counter(expected.collect())
        assert ("BroadcastExchange" in _plan(got).split("== Initial Plan ==")[-1]) == (limit > 0)


def test_a_million_codes(spark):
    table = spark.range(1_000_000).selectExpr("id AS position", "CAST(id AS STRING) AS code", "concat('L', id) AS label")
    # A third of the rows share one code.
    rows = spark.range(90_000).selectExpr("id AS i", "CAST(IF(id % 3 = 0, 7, id * 13) AS STRING) AS c")
    got = decode_by_table(rows, "c", table, default="Unknown", name="label")
    expected = F.expr("IF(CAST(c AS BIGINT) < 1000000, concat('L', c), 'Unknown')")
    assert got.filter(F.col("label") != expected).count() == 0 and got.count() == 90_000


# --- references -------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_a_table_of_references_keeps_the_rows_of_the_list_mode(spark, seed):
    rng = random.Random(seed)
    refs = ["".join(rng.choice("abAB_%,é") for _ in range(rng.randint(0, 3))) for _ in range(300)] + [None, "\\", "a\\"]
    rows = spark.createDataFrame(list(enumerate(refs)), RAW)
    listed = ["".join(rng.choice("abAB_%é\\") for _ in range(rng.randint(0, 4))) for _ in range(40)]
    table = spark.createDataFrame(list(enumerate(listed))[::-1], "position int, reference string")
    got = ref_filter_by_table(rows, "ref", table)
    text = ",".join(listed)
    list_mode = rows.filter(F.when(F.lit(True), reference_predicate(F.col("ref"), text.replace("%", "x"))) if "%" not in text else _list_only(text))
    assert got.columns == rows.columns and Counter(got.collect()) == Counter(list_mode.collect())


def _list_only(text):
    """The list mode for a text that has a percent sign too, where the filter adds the wildcard mode."""
    return F.expr("true") & F.like(F.lit(f",{text},".upper()), F.concat(F.lit("%,"), F.coalesce(F.upper("ref"), F.lit("")), F.lit(",%")), F.lit("\u0001"))


def test_a_hundred_thousand_references(spark):
    table = spark.range(100_000).selectExpr("id AS position", "concat('Ref', id) AS reference")
    rows = spark.range(3_000).selectExpr("id AS i", "CASE WHEN id % 10 = 0 THEN concat('rEF', id, '_') WHEN id % 10 = 1 THEN concat('ref', id * 77) ELSE 'x' END AS ref")
    got = {r.i for r in ref_filter_by_table(rows, "ref", table).collect()}
    assert got == {i for i in range(3_000) if (i % 10 == 0 and i > 0) or (i % 10 == 1 and i * 77 < 100_000)}


# --- ranks ------------------------------------------------------------------------------------


@pytest.mark.parametrize("slices", [1, 4, 1024])
@pytest.mark.parametrize("descending", [True, False])
def test_ranks_equal_one_window(spark, monkeypatch, slices, descending):
    monkeypatch.setattr(numbering, "SLICES", slices)
    monkeypatch.setattr(numbering, "SAMPLE_ROWS", 32 * slices)
    rng = random.Random(3)
    values = [None, None] + [rng.randrange(90) for _ in range(400)] + [5] * 200
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v long")
    order = F.col("v").desc_nulls_first() if descending else F.col("v").asc_nulls_last()
    expected = rows.withColumn("rank", F.rank().over(Window.orderBy(order)).cast("long"))
    got = global_rank(rows, "v", descending=descending)
    assert Counter(got.collect()) == Counter(expected.collect())
    assert global_rank(rows.limit(0), "v").count() == 0


def test_ranks_of_a_million_groups(spark):
    rows = spark.range(1_000_000).selectExpr("id", "pmod(xxhash64(id), 300000) AS v")
    got = global_rank(rows, "v")
    counts = rows.groupBy("v").count().toPandas().sort_values("v", ascending=False)
    counts["rank"] = counts["count"].cumsum() - counts["count"] + 1
    expected = int((counts["rank"] * counts["count"]).sum())
    assert got.agg(F.sum("rank"), F.count("*")).first() == (expected, 1_000_000)


# --- slices -----------------------------------------------------------------------------------


def test_slices_of_one_transaction_on_one_day_are_even(spark):
    """Timestamps of one day and texts: the largest cell has at most three times the rows of the median."""
    rows = spark.range(300_000).selectExpr("timestamp_micros(1700000000000000 + pmod(xxhash64(id), 80000000000)) AS at", "concat('S', id) AS text", "id")
    for order in ("at", "text"):
        sizes = sliced(rows, f"struct({order} IS NULL AS none, {order} AS value, xxhash64(id) AS tie)").groupBy("_slice").count().toPandas()["count"]
        assert len(sizes) > 500 and sizes.max() <= 3 * sizes.median()
        got = sequence_number(rows.selectExpr("'t' AS txn", "*"), ["txn"], order, ["id"])
        window = Window.partitionBy("txn").orderBy(order, F.xxhash64("id"), "id")
        checked = got.withColumn("expected", F.row_number().over(window))
        assert checked.filter("rn != expected").count() == 0


# --- CSV --------------------------------------------------------------------------------------


def test_good_and_rejected_rows_are_all_lines(spark, tmp_path):
    schema = TRIP_TABLES["fact_passenger_summary"]
    lines = ["2024-01-01,1,1,2,3", "2024-01-01,2,x,2,3", "2024-13-01,3,1,2,3", "2024-01-01,4,1,2", "2024-01-01,5,1,2,3,4", '"2024-01-01","6",1,2,3', ",,,,", "no,line", '2024-01-01,"a,b",,2,y']
    (tmp_path / "a.csv").write_text("\n".join([",".join(schema.names), *lines]) + "\n")
    good, rejected = read_csv_checked(spark, str(tmp_path / "a.csv"), schema)
    assert good.schema == schema
    assert sorted((r.city_id or "", r.total_passengers) for r in good.collect()) == [("", None), ("1", 3), ("6", 3)]
    assert {(r.line, r.reason) for r in rejected.collect()} == {
        (lines[1], "new_passengers is no int: x"),
        (lines[2], "month is no date: 2024-13-01"),
        (lines[3], "number of columns"),
        (lines[4], "number of columns"),
        (lines[7], "month is no date: no"),
        (lines[8], "total_passengers is no int: y"),
    }
    assert good.count() + rejected.count() == len(lines)
    assert all(r.file.endswith("a.csv") for r in rejected.collect())


# --- documents --------------------------------------------------------------------------------

DOCUMENTS = [
    '{"a":"x","b":1}', '{"a":"","b":null}', '{"a":{"c":1},"b":[1,2]}', '{"a":"{brace","b":"[x"}', '{"a":1.5,"b":true}', '{"a":1,"a":2}',
    '{"a":1} text', '{"a":1}{"a":2}', "no document", "", None, "[1]", '"a"', '{"a":"é\\u00e9","b":-0}', "{}", '{"a":12345678901234567890}',
]


def test_a_written_variant_gives_the_values_of_the_text(spark):
    rows = spark.createDataFrame(list(enumerate(DOCUMENTS)), "i int, doc string")
    fields = {"a": "first", "b": "second"}
    path = scratch_path(spark, "variants")
    sound_variant(rows, "doc").write.parquet(path)
    got = with_variant_fields(spark.read.parquet(path), "doc", fields)
    assert "parse" not in _plan(got).lower().replace("parquet", "")
    expected = with_json_fields(rows, "doc", fields).drop("doc")
    assert Counter(got.drop("doc").collect()) == Counter(expected.collect())
    assert _plan(sound_variant(rows, "doc").select("doc")).count("parseJson") == 1
