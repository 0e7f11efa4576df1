"""Numbering and pairing against brute force, with narrow and wide slices and cells."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Window, functions as F

from tallyline.operators import numbering
from tallyline.operators.numbering import sequence_number
from tallyline.operators.matching import _meetings, match_legs
from tallyline.operators.pairing import pair_by_sequence, pair_by_txn

LEG = "txn string, side string, seq long, carrier string"


def _legs(seed: int = 7, rows: int = 3000, hot_share: float = 0.34, ties: bool = False):
    """Random legs: a third of them in one transaction, some without a transaction id or sequence."""
    rng = random.Random(seed)
    legs = []
    for i in range(rows):
        draw = rng.random()
        txn = "hot" if draw < hot_share else None if draw < hot_share + 0.05 else f"t{rng.randrange(rows // 4)}"
        side = rng.choice(["OUT", "IN"])
        seq = None if rng.random() < 0.02 else (rng.randrange(5) if ties else i * 3)
        legs.append((txn, side, seq, f"c{i}"))
    rng.shuffle(legs)
    return legs


def _numbers(legs):
    groups = defaultdict(list)
    for txn, side, seq, carrier in legs:
        groups[txn, side].append((seq is None, seq or 0, carrier))
    return {c: n for group in groups.values() for n, (_, _, c) in enumerate(sorted(group), 1)}


@pytest.fixture(params=[0, 5, 20])
def slice_bits(request, monkeypatch):
    """Slices of one, 32 and a million order values."""
    monkeypatch.setattr(numbering, "SLICE_BITS", request.param)


def test_sequence_number_equals_brute_force(spark, slice_bits):
    legs = [leg for leg in _legs() if leg[2] is not None]
    got = sequence_number(spark.createDataFrame(legs, LEG), ["txn", "side"], "seq", ["carrier"])
    assert {r.carrier: r.rn for r in got.collect()} == _numbers(legs)


def test_ties_and_nulls_are_numbered_without_gaps(spark, slice_bits):
    legs = _legs(ties=True)
    got = sequence_number(spark.createDataFrame(legs, LEG), ["txn", "side"], "seq", ["carrier"])
    groups = defaultdict(list)
    for r in got.collect():
        groups[r.txn, r.side].append((r.rn, r.seq))
    assert sum(map(len, groups.values())) == len(legs)
    for group in groups.values():
        group.sort()
        assert [rn for rn, _ in group] == list(range(1, len(group) + 1))
        order = [float("inf") if seq is None else seq for _, seq in group]
        assert order == sorted(order)


ORDERS = {
    "long": "seq",
    "int": "CAST(seq AS INT)",
    "decimal": "CAST(seq / 8 AS DECIMAL(18,3))",
    "double": "IF(seq = 12, double('NaN'), IF(seq = 9, double('-Infinity'), CAST(seq - 1500 AS DOUBLE) / 8))",
    "timestamp": "timestamp_micros(seq * 3000000000)",
    "timestamp_ntz": "CAST(timestamp_micros(seq * 3000000000) AS TIMESTAMP_NTZ)",
    "date": "date_add(DATE '2024-01-01', CAST(seq AS INT))",
    "string": "CAST(seq AS STRING)",
}


@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("kind", ORDERS)
def test_slices_give_the_rows_of_one_window(spark, monkeypatch, kind, ties):
    """Any width of a slice numbers and pairs alike, for every type, with ties, NULLs and identical rows."""
    rows = spark.createDataFrame(_legs(rows=600, ties=ties) + _legs(rows=600, ties=ties)[:200], LEG)
    rows = rows.withColumn("seq", F.expr(ORDERS[kind]))
    window = Window.partitionBy("txn", "side").orderBy(F.col("seq").asc_nulls_last(), F.xxhash64("carrier"), "carrier")
    expected = Counter(map(str, rows.withColumn("rn", F.row_number().over(window).cast("long")).collect()))
    tagged = rows.withColumns({"source": F.col("carrier"), "target": F.col("carrier")})
    pairs = []
    for bits in (0, 3, 40):
        monkeypatch.setattr(numbering, "SLICE_BITS", bits)
        got = sequence_number(rows, ["txn", "side"], "seq", ["carrier"])
        assert Counter(map(str, got.collect())) == expected
        pairs.append(Counter(map(str, pair_by_sequence(tagged, ["txn"], "seq", out_columns=["source"], in_columns=["target"]).collect())))
    assert pairs[0] == pairs[1] == pairs[2]


def _brute_pairs(legs, strict, keep_unmatched=True):
    outs = [leg for leg in legs if leg[1] == "OUT"]
    ins = [leg for leg in legs if leg[1] == "IN"]
    numbers = _numbers(legs)
    found = defaultdict(list)
    for txn, _, _, carrier in ins:
        if txn is not None:
            found[txn, numbers[carrier] if strict else 0].append(carrier)
    pairs = Counter()
    for txn, _, _, carrier in outs:
        partners = found.get((txn, numbers[carrier] if strict else 0), [])
        if partners or keep_unmatched:
            pairs.update((txn, carrier, partner) for partner in (partners or [None]))
    return pairs


def _sides(spark, legs):
    rows = spark.createDataFrame(legs, LEG)
    outs = rows.filter("side = 'OUT'").select("txn", F.col("carrier").alias("source"), F.col("seq").alias("out_seq"))
    return outs, rows.filter("side = 'IN'").select("txn", F.col("carrier").alias("target"))


@pytest.mark.parametrize("keep", [True, False])
@pytest.mark.parametrize("cell_rows", [1, 10, 60, 10**6])
def test_pair_by_txn_equals_brute_force(spark, cell_rows, keep):
    legs = _legs(rows=900)
    outs, ins = _sides(spark, legs)
    got = pair_by_txn(outs, ins, ["txn"], cell_rows=cell_rows, keep_unmatched=keep)
    assert Counter((r.txn, r.source, r.target) for r in got.collect()) == _brute_pairs(legs, False, keep)


@pytest.mark.parametrize("lonely", ["OUT", "IN"])
@pytest.mark.parametrize("keep", [True, False])
def test_hot_transaction_with_one_side_only(spark, lonely, keep):
    legs = [leg for leg in _legs(rows=900) if leg[0] != "hot" or leg[1] == lonely]
    outs, ins = _sides(spark, legs)
    got = pair_by_txn(outs, ins, ["txn"], cell_rows=20, keep_unmatched=keep)
    assert Counter((r.txn, r.source, r.target) for r in got.collect()) == _brute_pairs(legs, False, keep)


@pytest.mark.parametrize("keep", [True, False])
def test_pair_by_sequence_equals_brute_force(spark, slice_bits, keep):
    legs = [leg for leg in _legs() if leg[2] is not None]
    rows = spark.createDataFrame(legs, LEG).withColumns({"source": F.col("carrier"), "target": F.col("carrier")})
    got = pair_by_sequence(
        rows, ["txn"], "seq", out_columns=["source"], in_columns=["target"], keep_unmatched=keep
    ).collect()
    assert Counter((r.txn, r.source, r.target) for r in got) == _brute_pairs(legs, True, keep)
    targets = [r.target for r in got if r.target is not None]
    assert len(targets) == len(set(targets))


@pytest.mark.parametrize("outs, ins, by_txn, strict", [(2, 3, 6, 2), (3, 1, 3, 3), (1, 0, 1, 1)])
def test_fan_out_against_strict_pairs(spark, outs, ins, by_txn, strict):
    legs = [("t", "OUT", i, f"o{i}") for i in range(outs)] + [("t", "IN", i, f"i{i}") for i in range(ins)]
    assert pair_by_txn(*_sides(spark, legs), ["txn"]).count() == by_txn
    rows = spark.createDataFrame(legs, LEG).withColumns({"source": F.col("carrier"), "target": F.col("carrier")})
    got = pair_by_sequence(rows, ["txn"], "seq", out_columns=["source"], in_columns=["target"]).collect()
    assert len(got) == strict
    assert sum(r.target is None for r in got) == max(0, outs - ins)


@pytest.mark.parametrize("others", [10, 400])
def test_a_wide_transaction_is_divided_whatever_stands_beside_it(spark, others):
    legs = [("wide", "OUT", i, f"o{i}") for i in range(50)] + [("wide", "IN", i, f"i{i}") for i in range(50)]
    legs += [(f"t{t}", side, i, f"{t}{side}{i}") for t in range(others) for side in ("OUT", "IN") for i in range(3)]
    rows = spark.createDataFrame(legs, LEG)
    met = _meetings(
        rows, ["txn"], "seq", columns=["carrier"], strict="false", attributes=None, wanted=None, side="side",
        keep_unmatched=True, cell_rows=20, cut=None,
    )
    cells = met.groupBy("_meeting").pivot("_side", ["OUT", "IN"]).count().collect()
    assert sorted((r.OUT, r.IN) for r in cells if r._meeting.txn == "wide") == sorted((o, i) for o in (20, 20, 10) for i in (20, 20, 10))
    assert len(cells) == 9 + others


def test_strict_and_free_keys_beside_each_other(spark):
    """Book-outs that are not wanted are numbered and leave; a NULL key has no partner."""
    legs = [(txn, side, i, f"{txn}{side}{i}") for txn in ("strict", "free", None) for side in ("OUT", "IN") for i in range(4)]
    rows = spark.createDataFrame([leg for leg in legs if leg[3] != "strictIN3"], LEG)
    got = match_legs(
        rows, ["txn"], "seq", out_columns={"source": "carrier"}, in_columns={"target": "carrier"},
        strict="txn = 'strict'", wanted=F.col("seq") != 1, cell_rows=3,
    )
    expected = [("strict", f"strictOUT{i}", f"strictIN{i}" if i < 3 else None) for i in (0, 2, 3)]
    expected += [("free", f"freeOUT{o}", f"freeIN{i}") for o in (0, 2, 3) for i in range(4)]
    expected += [(None, f"NoneOUT{o}", None) for o in (0, 2, 3)]
    assert Counter(map(tuple, got.collect())) == Counter(expected)


def _copies(rows: int):
    """A third of the legs are copies of one book-out, another sixth copies of one book-in."""
    legs = _legs(rows=rows)
    legs += [("hot", "OUT", 77, "same out")] * (rows // 2) + [("hot", "IN", 78, "same in")] * (rows // 4)
    return legs + [("hot", "OUT", None, "no sequence")] * (rows // 8)


def test_identical_legs_are_numbered_and_paired(spark, slice_bits):
    legs = [leg for leg in _copies(800) if leg[2] is not None or leg[3] == "no sequence"]
    rows = spark.createDataFrame(legs, LEG)
    got = sequence_number(rows, ["txn", "side"], "seq", ["carrier"]).collect()
    assert Counter((r.txn, r.side, r.seq, r.carrier) for r in got) == Counter(legs)
    groups = defaultdict(list)
    for r in got:
        groups[r.txn, r.side].append((r.rn, r.seq is None, r.seq or 0))
    for group in groups.values():
        group.sort()
        assert [rn for rn, *_ in group] == list(range(1, len(group) + 1))
        assert [order for _, *order in group] == sorted(order for _, *order in group)

    outs = [leg for leg in legs if leg[0] == "hot" and leg[1] == "OUT"]
    ins = [leg for leg in legs if leg[0] == "hot" and leg[1] == "IN"]
    order = lambda leg: (leg[2] is None, leg[2] or 0)
    expected = Counter((o[3], i[3]) for o, i in zip(sorted(outs, key=order), sorted(ins, key=order)))
    expected.update((o[3], None) for o in sorted(outs, key=order)[len(ins) :])
    tagged = rows.withColumns({"source": F.col("carrier"), "target": F.col("carrier")})
    pairs = pair_by_sequence(tagged, ["txn"], "seq", out_columns=["source"], in_columns=["target"])
    assert Counter((r.source, r.target) for r in pairs.filter("txn = 'hot'").collect()) == expected


@pytest.mark.parametrize("cell_rows", [25, 10_000])
def test_identical_legs_fan_out(spark, cell_rows):
    legs = _copies(240)
    outs, ins = _sides(spark, legs)
    got = pair_by_txn(outs, ins, ["txn"], cell_rows=cell_rows)
    assert Counter((r.txn, r.source, r.target) for r in got.collect()) == _brute_pairs(legs, False)
