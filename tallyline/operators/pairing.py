"""Pairing the two legs of a move, given as two tables or as tagged legs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from tallyline.operators.matching import match_in_place, match_legs
from tallyline.sources.layouts import BucketedLedger


def pair_by_txn(
    outs: DataFrame, ins: DataFrame, keys: Sequence[str], *, keep_unmatched: bool = True, cell_rows: int | None = None
) -> DataFrame:
    """Join of book-outs to book-ins on the transaction: every match is a row.

    A left join, or an inner one if the caller drops unmatched book-outs anyway. Apart from the keys
    the two sides must not share a column name. m book-outs and n book-ins of one transaction give
    m x n rows, as the ledger query does, made in cells of ``cell_rows`` legs per side; see :func:`match_legs`.
    """
    keys = list(keys)

    def tagged(rows: DataFrame, side: str) -> DataFrame:
        own = [c for c in rows.columns if c not in keys]
        # Legs without an order are numbered by the leading bits of a hash, and cut by them.
        return rows.select(*keys, F.lit(side).alias("_tag"), F.shiftright(F.xxhash64(*rows.columns), 56).alias("_spread"), *own)

    legs = tagged(outs, "OUT").unionByName(tagged(ins, "IN"), allowMissingColumns=True)
    columns = lambda rows: [c for c in rows.columns if c not in keys]
    return match_legs(
        legs,
        keys,
        "_spread",
        out_columns=columns(outs),
        in_columns=columns(ins),
        side="_tag",
        keep_unmatched=keep_unmatched,
        cell_rows=cell_rows,
        cut="_spread",
    )


def pair_by_sequence(
    legs: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    out_columns: Sequence[str],
    in_columns: Sequence[str],
    side: str = "side",
    keep_unmatched: bool = True,
) -> DataFrame:
    """n-th book-out to n-th book-in of a transaction.

    A book-out without partner has NULLs, or is dropped without ``keep_unmatched``. ``legs`` holds
    both sides, tagged ``OUT`` and ``IN``. Returns the keys, ``out_columns`` and ``in_columns``.
    """
    slim = legs.select(*dict.fromkeys([*keys, side, order, *out_columns, *in_columns]))
    return match_legs(
        slim, keys, order, out_columns=out_columns, in_columns=in_columns, strict="true", side=side, keep_unmatched=keep_unmatched
    )


def pair_bucketed_by_sequence(
    ledger: BucketedLedger,
    legs_of: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    order: str,
    *,
    out_columns: Sequence[str],
    in_columns: Sequence[str],
    side: str = "side",
    keep_unmatched: bool = True,
) -> DataFrame:
    """The pairs of :func:`pair_by_sequence` from a ledger bucketed by transaction, which is not shuffled.

    ``legs_of`` makes tagged legs of ledger rows; the transaction is one of the ``keys``, as it is in the ledger. Transactions too large for a bucket are
    shuffled and divided like any others; legs without a transaction have no partner.
    """
    columns = {"out_columns": out_columns, "in_columns": in_columns, "side": side, "keep_unmatched": keep_unmatched}

    def slim(rows: DataFrame) -> DataFrame:
        return legs_of(rows).select(*dict.fromkeys([*keys, side, order, *out_columns, *in_columns]))

    pairs = match_in_place(slim(ledger.light), keys, order, **columns)
    if ledger.heavy is not None:
        pairs = pairs.unionByName(match_legs(slim(ledger.heavy), keys, order, strict="true", **columns))
    if keep_unmatched:
        lonely = slim(ledger.unknown).filter(F.col(side) == "OUT").select(*keys, *out_columns)
        pairs = pairs.unionByName(lonely, allowMissingColumns=True)
    return pairs
