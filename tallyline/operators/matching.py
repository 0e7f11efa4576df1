"""Matching the two sides of moves inside one set of tagged legs: the legs are scanned once.

One exchange of the legs feeds everything: the counts per cell, the numbering, and both sides of the pairs. Spark
runs it once, because every reader needs all of its columns and so reads the same exchange. Expressions are SQL text: a
plan of many small columns takes longer to build from Python than to run on a small table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyline.operators.numbering import order_cell

# Pairs on the id alone are made in cells of at most so many legs per side.
CELL_ROWS = 500


def _struct(names: Sequence[str]) -> str:
    return f"struct({', '.join(f'`{name}`' for name in names)})"


def _all(keys: Sequence[str], row: str = "") -> str:
    """SQL: no key is NULL."""
    return "(" + " AND ".join(f"{row}`{key}` IS NOT NULL" for key in keys) + ")"


def number_legs(
    legs: DataFrame, keys: Sequence[str], order: str, side: str, strict: str = "false", cut: str | None = None
) -> DataFrame:
    """``_cell, _side, _leg, _strict, _rn, _outs, _ins``: each leg with its number, and the sizes of its group.

    ``_leg`` holds all columns but the keys and the side. Legs are numbered per key and side by ``order``, NULL last, then by a
    hash of the leg and the leg itself. A cell is a slice of a key's order values: a key with a third of all legs is divided
    over the tasks. Counts are added up per key from one row for each cell. ``cut`` gives the slices, if not the order values' own;
    ``strict`` is a condition to keep.
    """
    keys = list(keys)
    held = [c for c in legs.columns if c not in (*keys, side)]
    cell = order_cell(legs, keys, order, f"xxhash64({', '.join(f'`{c}`' for c in held)})", cut)
    shared = legs.selectExpr(f"{cell} AS _cell", f"`{side}` AS _side", f"{_struct(held)} AS _leg", f"coalesce({strict}, false) AS _strict").repartition("_cell")
    # Counting the legs themselves, and ordering by all of a leg, needs the whole row: no reader gets a narrower exchange.
    count = lambda of: f"count(CASE WHEN _side = '{of}' THEN struct(_leg, _strict) END)"
    sizes = shared.groupBy("_cell").agg(F.expr(f"{count('OUT')} AS _cell_outs"), F.expr(f"{count('IN')} AS _cell_ins"))
    of_key = "PARTITION BY " + ", ".join(f"_cell.`{key}`" for key in keys)
    earlier = f"{of_key} ORDER BY _cell._slice NULLS LAST, _cell._part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    offsets = sizes.selectExpr(
        "_cell",
        f"coalesce(sum(_cell_outs) OVER ({earlier}), 0) AS _outs_before",
        f"coalesce(sum(_cell_ins) OVER ({earlier}), 0) AS _ins_before",
        f"sum(_cell_outs) OVER ({of_key}) AS _outs",
        f"sum(_cell_ins) OVER ({of_key}) AS _ins",
    )
    own = f"row_number() OVER (PARTITION BY _cell, _side ORDER BY _leg.`{order}` NULLS LAST, xxhash64(_leg), _leg) AS _own"
    return shared.selectExpr("*", own).join(offsets, "_cell").selectExpr(
        "_cell", "_side", "_leg", "_strict", "_own + IF(_side = 'OUT', _outs_before, _ins_before) AS _rn", "_outs", "_ins"
    )


def _meetings(
    legs: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    columns: Sequence[str],
    strict: str,
    attributes: Callable[[DataFrame], DataFrame] | None,
    wanted: Column | None,
    side: str,
    keep_unmatched: bool,
    cell_rows: int,
    cut: str | None,
) -> DataFrame:
    """``_meeting, _side, _leg``: the legs, reduced to ``columns``, in every cell where they meet partners."""
    legs = legs.filter(f"{_all(keys)} OR `{side}` = 'OUT'" if keep_unmatched else _all(keys))
    placed = number_legs(legs, keys, order, side, strict, cut).selectExpr("*", "IF(_side = 'OUT', _ins, _outs) AS _others")
    placed = placed.selectExpr("*", f"{_all(keys, '_cell.')} AND IF(_strict, _rn <= _others, _others > 0) AS _matched")
    placed = placed.filter("_matched OR _side = 'OUT'" if keep_unmatched else "_matched")
    placed = placed.selectExpr("_cell", "_side", "_rn", "_others", "_strict", "_matched", "_leg.*")
    if attributes is not None:
        placed = attributes(placed)
    if wanted is not None:
        placed = placed.filter((F.col("_side") == "IN") | wanted)
    # Strict pairs, and legs without partners, stand alone; other legs go to all cells of their row or column.
    block = lambda value: f"(({value} - 1) div {cell_rows})"
    placed = placed.selectExpr(
        "_cell",
        "_side",
        f"{_struct(dict.fromkeys(columns))} AS _leg",
        f"IF(_strict OR NOT _matched, _rn, {block('_rn')}) AS _own",
        f"explode(IF(_strict OR NOT _matched, array(IF(_matched, _rn, -1L)), sequence(0L, {block('_others')}))) AS _other",
    )
    names = ", ".join(f"_cell.`{key}` AS `{key}`" for key in keys)
    place = "IF(_side = 'OUT', _own, _other) AS _row, IF(_side = 'OUT', _other, _own) AS _column"
    return placed.selectExpr(f"struct({names}, {place}) AS _meeting", "_side", "_leg")


def match_legs(
    legs: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    out_columns: Sequence[str] | Mapping[str, str],
    in_columns: Sequence[str] | Mapping[str, str],
    strict: str = "false",
    attributes: Callable[[DataFrame], DataFrame] | None = None,
    wanted: Column | None = None,
    side: str = "side",
    keep_unmatched: bool = True,
    cell_rows: int | None = None,
    cut: str | None = None,
) -> DataFrame:
    """Book-outs (``OUT``) with their book-ins (``IN``): the keys, ``out_columns`` and ``in_columns``, or new names for columns.

    Where ``strict`` holds, a SQL condition that is the same for all legs of a key, the n-th book-out meets the n-th book-in by
    ``order``; elsewhere every book-out meets every book-in of its key: m x n rows. They meet in cells of ``cell_rows`` by
    ``cell_rows`` legs, chosen by their numbers, so no task holds more of a key. Legs without a partner leave before that. Then ``attributes`` adds
    columns that are dear to read, and book-outs leave that are not ``wanted``, a condition on all columns. A book-out without a
    partner has NULLs, or is dropped without ``keep_unmatched``. A NULL key has no partner.
    """
    keys, outs, ins = list(keys), _by_name(out_columns), _by_name(in_columns)
    placed = _meetings(
        legs,
        keys,
        order,
        columns=[*outs.values(), *ins.values()],
        strict=strict,
        attributes=attributes,
        wanted=wanted,
        side=side,
        keep_unmatched=keep_unmatched,
        cell_rows=cell_rows or CELL_ROWS,
        cut=cut,
    )
    partners = f"collect_list(IF(_side = 'IN', {_partner(ins)}, NULL)) OVER (PARTITION BY _meeting) AS _partners"
    met = placed.selectExpr("*", partners).filter("_side = 'OUT'")
    spread = "explode_outer" if keep_unmatched else "explode"
    return met.selectExpr("_meeting", "_leg", f"{spread}(_partners) AS _in").selectExpr(
        *[f"_meeting.`{key}` AS `{key}`" for key in keys], *_sides(outs, ins)
    )


def _partner(ins: Mapping[str, str]) -> str:
    return "struct(" + ", ".join(f"_leg.`{source}` AS `{name}`" for name, source in ins.items()) + ")"


def _sides(outs: Mapping[str, str], ins: Mapping[str, str]) -> list[str]:
    return [f"_leg.`{source}` AS `{name}`" for name, source in outs.items()] + [f"_in.`{name}` AS `{name}`" for name in ins]


def match_in_place(
    legs: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    out_columns: Sequence[str] | Mapping[str, str],
    in_columns: Sequence[str] | Mapping[str, str],
    side: str = "side",
    keep_unmatched: bool = True,
) -> DataFrame:
    """The strict pairs of :func:`match_legs` by windows alone: no exchange where legs are already partitioned by some of the keys.

    A key's legs stay in one task. Keys are not NULL.
    """
    keys, outs, ins = list(keys), _by_name(out_columns), _by_name(in_columns)
    held = [c for c in legs.columns if c not in (*keys, side)]
    by_key = "PARTITION BY " + ", ".join(f"`{key}`" for key in keys)
    rn = f"row_number() OVER ({by_key}, _side ORDER BY _leg.`{order}` NULLS LAST, xxhash64(_leg), _leg) AS _rn"
    # OUT before IN
    partner = f"lead(IF(_side = 'IN', {_partner(ins)}, NULL)) OVER ({by_key}, _rn ORDER BY _side DESC) AS _in"
    numbered = legs.selectExpr(*[f"`{key}`" for key in keys], f"`{side}` AS _side", f"{_struct(held)} AS _leg").selectExpr("*", rn)
    pairs = numbered.selectExpr("*", partner).filter("_side = 'OUT'" if keep_unmatched else "_side = 'OUT' AND _in IS NOT NULL")
    return pairs.selectExpr(*[f"`{key}`" for key in keys], *_sides(outs, ins))


def _by_name(columns: Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    return dict(columns) if isinstance(columns, Mapping) else {name: name for name in columns}
