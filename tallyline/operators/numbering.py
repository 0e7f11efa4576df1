"""Row numbers inside a group, by one plan for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

# Numbers are cut into slices at multiples of 2 ** SLICE_BITS.
SLICE_BITS = 20
# Sampled slices of the rows, and rows of the sample.
SLICES = 1024
SAMPLE_ROWS = 32 * SLICES
_COUNT_ONE_IN = 256


def order_slice(order: str, kind: T.DataType) -> str:
    """SQL: a slice number that grows with the order value and depends on nothing else.

    Numbers are cut at fixed multiples, timestamps at days; other types make one slice. A slice that is too wide or
    narrow for the data costs balance, never the order.
    """
    if isinstance(kind, T.IntegralType):
        return f"shiftright(CAST({order} AS BIGINT), {SLICE_BITS})"
    if isinstance(kind, T.DecimalType):
        return f"floor({order} / {1 << SLICE_BITS}L)"
    if isinstance(kind, T.FractionalType):
        # NaN is the greatest value.
        return f"IF(isnan({order}), {2**63 - 1}L, floor({order} / {1 << SLICE_BITS}L))"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return f"date_trunc('day', {order})"
    return f"IF({order} IS NULL, NULL, 0)"


def order_cell(rows: DataFrame, keys: Sequence[str], order: str, tie: str, cut: str | None = None) -> str:
    """SQL: the keys with a slice of their order values, as one struct that is never NULL itself.

    Windows and joins on it share one partitioning, and NULL keys are equal. Rows without an order value are divided by
    the leading bits of the hash ``tie``, which grow with it. ``cut`` is a slice number in place of the usual one.
    """
    cut = order_slice(f"`{order}`", rows.schema[order].dataType) if cut is None else cut
    names = "".join(f"`{key}`, " for key in keys)
    return f"struct({names}{cut} AS _slice, IF(`{order}` IS NULL, shiftright({tie}, 56), 0L) AS _part)"


def sliced(rows: DataFrame, place: str) -> DataFrame:
    """``rows`` with ``_place``, the SQL value ``place``, and ``_slice``: a number that grows with it, so that slices have about the same size.

    At most ``SLICES`` - 1 sampled values are the splitters. The rows whose hash lies below a share are the sample, so each run and
    each reader gets the same slices. The share comes from a count of rows by hash: the sample has about ``SAMPLE_ROWS``
    rows whatever the volume. NULL fields of a struct come first.
    """
    rows = rows.selectExpr("*", f"{place} AS _place")
    draw = f"pmod(xxhash64(_place, 'sample'), {1 << 52}L) / {float(1 << 52)}D"
    counted = rows.agg(F.expr(f"{_COUNT_ONE_IN} * (1 + count(IF({draw} < {1 / _COUNT_ONE_IN}D, 1, NULL))) AS n")).scalar()
    drawn = F.expr(draw) * counted < SAMPLE_ROWS
    sample = rows.agg(F.sort_array(F.collect_list(F.when(drawn, F.col("_place")))).alias("s"))
    step = f"greatest(1, CAST(ceil(size(s) / {SLICES}) AS INT))"
    picked = f"IF(size(s) > {step}, transform(sequence({step}, size(s) - 1, {step}), i -> s[i]), slice(s, 1, 0))"
    # The number of splitters that are not beyond the place, by halving.
    strides = ", ".join(str(1 << k) for k in reversed(range(SLICES.bit_length())))
    halve = "IF(get(_bounds, n + stride - 1) <= _place, n + stride, n)"
    found = f"aggregate(array({strides}), 0, (n, stride) -> IF(n + stride <= size(_bounds), {halve}, n)) AS _slice"
    names = [f"`{c}`" for c in rows.columns]
    return rows.withColumn("_bounds", sample.selectExpr(f"{picked} AS bounds").scalar()).selectExpr(*names, found)


def sequence_number(
    rows: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str], *, name: str = "rn"
) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order)``, NULL order values last.

    Equal order values are numbered by a hash of the ``ties`` columns, then by these: arbitrary, but the same
    on every run. All rows are cut into slices of about the same size by splitters over (order value, hash of the ties), which
    are sampled, whatever the type and the spread of the order values: a group that a third of all rows share lies in a third of the
    slices. Each slice of a group is numbered on its own, and the rows of its earlier slices are added. Rows that agree in the
    order and all ties stay together. One exchange of the rows feeds the numbers and the counts.
    """
    quoted = lambda names, row="": ", ".join(f"{row}`{c}`" for c in names)
    columns = rows.columns
    # One struct, never NULL itself: windows and join share one partitioning, and NULL keys are equal.
    packed = rows.selectExpr(f"struct({quoted(keys)}) AS _keys", f"struct({quoted(columns)}) AS _row", f"xxhash64({quoted(ties)}) AS _tie")
    placed = sliced(packed, f"struct(_row.`{order}` IS NULL AS none, _row.`{order}` AS value, _tie AS tie)")
    shared = placed.selectExpr("struct(_keys, _slice) AS _cell", "_row", "_tie").repartition("_cell")
    # Counting the rows themselves keeps the exchange the same for both readers; it runs once.
    sizes = shared.groupBy("_cell").agg(F.expr("count(IF(_cell._slice >= 0, struct(_row, _tie), NULL)) AS _rows"))
    before = "sum(_rows) OVER (PARTITION BY _cell._keys ORDER BY _cell._slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = sizes.selectExpr("_cell", f"coalesce({before}, 0) AS _before")
    inside = f"PARTITION BY _cell ORDER BY _row.`{order}` NULLS LAST, _tie, {quoted(ties, '_row.')}, xxhash64(_row)"
    numbered = shared.selectExpr("*", f"row_number() OVER ({inside}) AS _own").join(offsets, "_cell")
    return numbered.selectExpr(*[f"_row.`{c}` AS `{c}`" for c in columns], f"_before + _own AS `{name}`")
