"""Edge rows of the column functions."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyline.functions import codes
from tallyline.functions.calendar import event_time_label, month_label, month_label_padded, month_start
from tallyline.functions.json_fields import with_json_fields
from tallyline.functions.ratios import percentage, safe_ratio
from tallyline.functions.text import all_digits, like, not_prefixed
from tallyline.operators.legs import completed_moves, ref_filter, window_filter

DOCUMENTS = {
    '{"K":{"p":1}}': None,
    '{"K":[1,2]}': None,
    '{"K":null}': None,
    "{}": None,
    '{"K":""}': None,
    "no document": None,
    '{"K":"a" broken': None,
    "": None,
    '[{"K":"a"}]': None,
    '{"K":1}': "1",
    '{"K":1.5}': "1.5",
    '{"K":true}': "true",
    '{"K":"{x"}': "{x",
    '{"K":"[x"}': "[x",
    '{"K":"{\\"p\\":1}"}': '{"p":1}',
    '{"K":" a "}': " a ",
    '{"A":{"K":"inner"},"K":"outer"}': "outer",
    '{"A":{"K":"inner"}}': None,
    ' {"K":"a"} ': "a",
    '{"K":"a"} junk': None,
    '{"K":"a"}{"K":"b"}': None,
    '{"K":"a"},{"K":"b"}': None,
    '{"K":"a"},null': None,
    '{"K":"a"},': None,
    '{"K":"1","K":"2"}': None,
    '{"K":{"B":1},"K":"2"}': None,
}


def _texts(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_json_values_are_scalars_or_null(spark):
    rows = _texts(spark, [*DOCUMENTS, None], "doc")
    found = {r.doc: (r.k, r.other) for r in with_json_fields(rows, "doc", {"K": "k", "L": "other"}).collect()}
    assert found == {doc: (value, None) for doc, value in {**DOCUMENTS, None: None}.items()}


def test_not_like_drops_null(spark):
    rows = _texts(spark, ["000123", "00", "4", None])
    assert {r.v for r in rows.filter(not_prefixed(F.col("v"), "000")).collect()} == {"00", "4"}


def test_like_has_no_escape_character(spark):
    rows = _texts(spark, ["a\\b", "a~b", "a%b", "axb"])
    assert {r.v for r in rows.filter(like(F.col("v"), F.lit("a\\b"))).collect()} == {"a\\b"}
    assert {r.v for r in rows.filter(like(F.col("v"), F.lit("a_b"))).collect()} == {"a\\b", "a~b", "a%b", "axb"}


def test_all_digits_takes_no_final_newline(spark):
    rows = _texts(spark, ["12", "12\n", "12a", "", " 1", None])
    assert [r.v for r in rows.filter(all_digits(F.col("v"))).collect()] == ["12"]


REFERENCES = ["A1", "a1", "B2", " B2", "A_", "A%", "ref9", "REF10", "A1,B2", "a\\b", "", None]


@pytest.mark.parametrize(
    "text, kept",
    [
        (None, REFERENCES),
        ("", REFERENCES),
        ("ref%", ["ref9", "REF10"]),
        ("%", None),
        ("a_%", ["A1", "a1", "A_", "A%", "A1,B2", "a\\b"]),
        ("a1", ["A1", "a1"]),
        ("A_", ["A_"]),  # without a percent sign or comma the text is literal
        ("A1,B2", ["A1", "a1", "B2", "A_", "A%", "A1,B2"]),  # references act as patterns
        ("A1, B2", ["A1", "a1", " B2", "A_", "A%"]),  # elements are not trimmed
        ("A1,,ref9", ["A1", "a1", "A_", "A%", "ref9", "", None]),  # an empty element finds NULL
        ("REF%,B2", None),  # wildcard or list
        ("A%,B2", None),
        ("a\\b", ["a\\b"]),
        ("a\\b,B2", ["B2", "a\\b", "A%"]),
    ],
)
def test_reference_filter_modes(spark, text, kept):
    def like_match(pattern, value):
        import re

        parts = [".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern]
        return re.fullmatch("".join(parts), value, re.S) is not None

    def expected(ref):
        if not text:
            return True
        wanted, own = text.upper(), None if ref is None else ref.upper()
        hit = False
        if "%" in text and own is not None:
            hit |= like_match(wanted, own)
        if "," in text:
            hit |= like_match("%," + (own or "") + ",%", "," + wanted + ",")
        if "%" not in text and "," not in text:
            hit |= own == wanted
        return hit

    got = sorted(str(r.v) for r in ref_filter(_texts(spark, REFERENCES), "v", text).collect())
    assert got == sorted(str(r) for r in REFERENCES if expected(r))
    if kept is not None:
        assert got == sorted(str(r) for r in kept)


TIMES = ["2024-01-01 00:00:00", "2024-01-01 12:00:00", "2024-01-02 00:00:00", "2024-01-02 00:00:01"]


@pytest.mark.parametrize(
    "start, end, kept",
    [
        ("01.01.2024 12:00:00", "02.01.2024 00:00:00", TIMES[1:3]),  # both ends belong to it
        ("01.01.2024 12:00:00", None, []),
        ("01.01.2024 12:00:00", "", []),
        (None, "01.01.2024 12:00:00", TIMES),
        ("", "01.01.2024 12:00:00", TIMES),
        (None, None, TIMES),
        ("02.01.2024 00:00:00", "01.01.2024 00:00:00", []),
    ],
)
def test_time_window(spark, start, end, kept):
    rows = _texts(spark, TIMES).select("v", F.col("v").cast("timestamp_ntz").alias("t"))
    assert sorted(r.v for r in window_filter(rows, "t", start, end).collect()) == kept


def test_malformed_window_raises(spark):
    rows = _texts(spark, TIMES).select(F.col("v").cast("timestamp_ntz").alias("t"))
    with pytest.raises(PySparkException):
        window_filter(rows, "t", "2024-01-01", "2024-01-02").collect()


def test_month_and_time_labels(spark):
    rows = _texts(spark, ["2024-05-17", "2024-09-30", None]).select(F.to_date("v").alias("d"))
    month = month_start(F.col("d"))
    got = rows.select(month.cast("string").alias("m"), month_label(month).alias("l"), month_label_padded(month).alias("p"))
    assert [tuple(r) for r in got.collect()] == [
        ("2024-05-01", "May", "May      "),
        ("2024-09-01", "September", "September"),
        (None, None, None),
    ]
    stamp = _texts(spark, ["2024-03-07 04:05:06.789"]).select(event_time_label(F.col("v").cast("timestamp_ntz")))
    assert stamp.first()[0] == "07.03.2024 04:05:06"


def test_time_labels_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = _texts(spark, ["2024-03-10 02:30:00", None]).select(F.col("v").cast("timestamp_ntz").alias("t"))
        assert [r[0] for r in rows.select(event_time_label(F.col("t"))).collect()] == ["10.03.2024 02:30:00", None]
        kept = window_filter(rows, "t", "10.03.2024 02:30:00", "10.03.2024 02:30:00")
        assert kept.count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_ratio_rounds_half_away_from_zero(spark):
    rows = spark.createDataFrame([(1, 3), (1, 800), (-1, 800), (-5, 7), (2, 0), (None, 3), (3, None), (0, 5)], "a long, b long")
    got = [tuple(r) for r in rows.select(percentage(F.col("a"), F.col("b")), safe_ratio(F.col("a"), F.col("b"), 0)).collect()]
    assert got == [
        (Decimal("33.33"), 0),
        (Decimal("0.13"), 0),
        (Decimal("-0.13"), 0),
        (Decimal("-71.43"), -1),
        (None, None),
        (None, None),
        (None, None),
        (Decimal("0.00"), 0),
    ]


def test_random_ratios_equal_exact_decimals(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(-(10**rng.randrange(1, 15)), 10**14), rng.randrange(1, 10 ** rng.randrange(1, 15))) for _ in range(3000)]
    pairs += [(2 * k + 1, 200) for k in range(-500, 500)]  # exact halves at the second decimal of a percentage
    rows = spark.createDataFrame(pairs, "a long, b long")
    for a, b, two, none in rows.select("a", "b", percentage(F.col("a"), F.col("b")), safe_ratio(F.col("a"), F.col("b"), 0)).collect():
        with localcontext() as context:
            context.prec = 60
            assert two == (Decimal(100 * a) / b).quantize(Decimal("0.01"), ROUND_HALF_UP)
            assert none == (Decimal(a) / b).quantize(Decimal(1), ROUND_HALF_UP)


def test_ratio_of_large_and_fractional_sums(spark):
    rows = spark.createDataFrame([(9_007_199_254_740_993, Decimal("2.00")), (1, Decimal("0.03"))], "a long, b decimal(28,2)")
    got = [r[0] for r in rows.select(safe_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [Decimal("4503599627370496.50"), Decimal("33.33")]


def test_decode_is_null_safe(spark):
    rows = _texts(spark, ["1", "10", "11", "2", None])
    got = rows.select(
        codes.decode_codes(F.col("v"), codes.SOURCE_LABELS, "Zircle"),
        codes.decode_codes(F.col("v"), {None: "none", "2": "two"}, None),
    )
    assert [tuple(r) for r in got.collect()] == [
        ("Zalando SE", None),
        ("OSR", None),
        ("OSR (OV)", None),
        ("Zircle", "two"),
        ("Zircle", "none"),
    ]


@pytest.mark.parametrize(
    "carrier, quality, channel, source, with_source, without",
    [
        ("501", "1", "4", "11", "Overstock", "Overstock"),
        ("41", "3", "4", "1", "Overstock", "Overstock"),
        ("41", "1", "4", "11", "Outlet", "Outlet"),
        ("41", "1", "3", "1", "Overstock", "Overstock"),
        ("41", "1", "2", "11", "Overstock", "Unknown"),
        (None, None, None, None, "Unknown", "Unknown"),
    ],
)
def test_distribution_channel(spark, carrier, quality, channel, source, with_source, without):
    row = spark.createDataFrame([(carrier, quality, channel, source)], "a string, b string, c string, d string")
    a, b, c, d = (F.col(n) for n in "abcd")
    assert tuple(row.select(codes.distribution_channel(a, b, c, d), codes.distribution_channel(a, b, c)).first()) == (
        with_source,
        without,
    )


def test_ean_rules(spark):
    cases = [
        # article, document, target, two-step, three-step
        ("21", "29", "22", "21", "21"),
        ("91", "29", "22", "29", "29"),
        ("91", None, "22", None, "22"),
        ("91", None, "92", None, "91"),
        (None, "29", "22", None, "29"),
        (None, None, "22", None, "22"),
        (None, None, None, None, None),
    ]
    rows = spark.createDataFrame(cases, "a string, d string, t string, two string, three string")
    a, d, t = (F.col(n) for n in "adt")
    for r in rows.select("two", "three", codes.ean_two_step(a, d).alias("x"), codes.ean_three_step(a, d, t).alias("y")).collect():
        assert (r.x, r.y) == (r.two, r.three)


def test_goods_type_picks_the_side(spark):
    rows = _texts(spark, ["NORMAL", "DUMMY", "OTHER", None])
    got = rows.select(codes.by_goods_type(F.col("v"), F.lit("out"), F.lit("in"))).collect()
    assert [r[0] for r in got] == ["out", "in", None, None]


def test_target_status(spark):
    rows = spark.createDataFrame([(2, 1), (1, 1), (0, 1), (None, 1), (1, None)], "a long, t long")
    got = [r[0].split()[0] for r in rows.select(codes.target_status(F.col("a"), F.col("t"))).collect()]
    assert got == ["Above", "Below", "Below", "Below", "Below"]


def test_completed_moves(spark):
    cases = [("1", "2", True), (None, "2", True), ("2", "2", False), ("1", None, False), (None, None, False), ("1", "2a", False), ("1", "2\n", False), ("value2", "7", True)]
    rows = spark.createDataFrame(cases, "s string, z string, keep boolean")
    assert completed_moves(rows, "s", "z").collect() == rows.filter("keep").collect()
