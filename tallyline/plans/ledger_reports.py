"""The two movement reports: one pipeline, two rule sets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallyline.functions import codes
from tallyline.functions.calendar import event_time_label, window_predicate
from tallyline.functions.text import reference_predicate
from tallyline.operators.legs import (
    DUMMY_IN,
    DUMMY_OUT,
    NORMAL_MOVE,
    LegSpec,
    completed_moves,
    has_variants,
    leg_attributes,
    legs,
    window_filter,
)
from tallyline.operators.matching import match_legs

# Column of a move -> column of the leg it comes from.
OUT_COLUMNS = {
    "created": "created", "created_by": "created_by", "article": "article", "destination": "destination",
    "source_carrier": "carrier", "quantity": "quantity", "reference": "reference", "document_ean": "document_ean",
    "source_id": "source_id", "quality_id": "quality_id", "category_id": "category_id", "channel_id": "channel_id",
    "sku": "sku", "sort_id": "sort_id",
}
IN_COLUMNS = {f"target_{name}": name for name in ("carrier", "article", "source_id", "channel_id", "sku", "sort_id")}


@dataclass(frozen=True)
class MovementRules:
    """What the reports do differently."""

    normal_out: LegSpec
    normal_in: LegSpec
    dummy_out: LegSpec
    dummy_in: LegSpec
    # False: code lookups read the book-out only, else the book-in first.
    completion_first: bool
    unknown_source: str


# Locations and destinations of the two areas.
_OVERSTOCK = ("Overstock", "SZROV")
_SORTING = ("IN_SZR_OV", "SZR_OV")

OVERSTOCK_RULES = MovementRules(
    normal_out=LegSpec(NORMAL_MOVE, "negative", locations=_OVERSTOCK, destination_prefix="OV"),
    normal_in=LegSpec(NORMAL_MOVE, "one", locations=_OVERSTOCK, excluded_carrier_prefix="000"),
    dummy_out=LegSpec(DUMMY_OUT, "negative", locations=_OVERSTOCK, destination_prefix="OV"),
    dummy_in=LegSpec(
        DUMMY_IN, "one", locations=_OVERSTOCK, destination_prefix="OV", excluded_carrier_prefix="000"
    ),
    completion_first=True,
    unknown_source="Unknown",
)
MANUAL_SORTING_RULES = MovementRules(
    normal_out=LegSpec(NORMAL_MOVE, "negative", destinations=_SORTING),
    normal_in=LegSpec(NORMAL_MOVE, "one", destinations=_SORTING),
    dummy_out=LegSpec(DUMMY_OUT, "negative", destinations=("IN_SZR_OV",), subtype=120),
    dummy_in=LegSpec(DUMMY_IN, "positive", destinations=_SORTING),
    completion_first=False,
    unknown_source="Zircle",
)


KEYS = ["txn", "goods"]


def _pairs(every: DataFrame, reference: str | None, keep_unmatched: bool, strict: str = "false") -> DataFrame:
    """Legs paired per (transaction, goods), strictly or on the id.

    Documents are parsed of legs with a partner only, after they are numbered; then the reference filter drops book-outs.
    """
    return match_legs(
        every,
        KEYS,
        "sequence",
        out_columns=OUT_COLUMNS,
        in_columns=IN_COLUMNS,
        strict=strict,
        attributes=leg_attributes if "document" in every.columns else None,
        wanted=reference_predicate(F.col("reference"), reference),
        keep_unmatched=keep_unmatched,
    )


def _overstock_legs(ledger: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """The legs of the overstock area with their documents, from one scan; the window holds for book-outs only."""
    rules = OVERSTOCK_RULES
    every = legs(ledger, rules.normal_out, rules.dummy_out, rules.normal_in, rules.dummy_in)
    inside = window_predicate(F.col("created"), start, end)
    every = every if inside is None else every.filter((F.col("side") == "IN") | inside)
    # Reading fields of a VARIANT is cheap, and it can't be compared.
    return leg_attributes(every) if has_variants(every) else every


def _with_attributes(every: DataFrame) -> DataFrame:
    return leg_attributes(every) if "document" in every.columns else every


def overstock_legs(ledger: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """All legs of the overstock area with their document fields; the window holds for book-outs only.

    Keep it (a written table, or ``persist``) and hand it to several reports as ``kept``; one report scans the ledger once
    in any case. The caller releases it.
    """
    return _with_attributes(_overstock_legs(ledger, start, end))


def overstock_movements(
    ledger: DataFrame,
    start: str | None = None,
    end: str | None = None,
    reference: str | None = None,
    *,
    kept: DataFrame | None = None,
    keep_unmatched: bool = True,
) -> DataFrame:
    """Normal and dummy moves paired on the transaction id, before the code lookups.

    Both kinds of goods are paired in one pass on (transaction, goods). A normal book-out without a
    book-in is kept; a dummy one is not, since the carrier condition on its book-in rejects NULL.
    The report reads completed moves only and asks for no unmatched ones. ``kept``, from
    :func:`overstock_legs` with the same window, is read in place of the ledger.
    """
    every = _overstock_legs(ledger, start, end) if kept is None else kept
    pairs = _pairs(every, reference, keep_unmatched)
    dummy = F.col("goods") == "DUMMY"
    two_step = codes.ean_two_step(F.col("article"), F.col("document_ean"))
    return pairs.filter(~dummy | F.col("target_carrier").isNotNull()).withColumn(
        "article", F.when(dummy, two_step).otherwise(F.col("article"))
    )


def _sorting_legs(ledger: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """The legs of the manual sorting area with their documents; the window holds for every leg.

    A normal move reads nothing but the carrier from its book-in, whose document goes.
    """
    rules = MANUAL_SORTING_RULES
    every = legs(window_filter(ledger, "CREATED", start, end), rules.normal_out, rules.normal_in, rules.dummy_out, rules.dummy_in)
    every = every.withColumn("document", F.expr("IF(goods = 'NORMAL' AND side = 'IN', NULL, document)"))
    return leg_attributes(every) if has_variants(every) else every


def sorting_legs(ledger: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """All legs of the manual sorting area with their document fields; keep it as ``kept`` like :func:`overstock_legs`."""
    return _with_attributes(_sorting_legs(ledger, start, end))


def manual_sorting_movements(
    ledger: DataFrame,
    start: str | None = None,
    end: str | None = None,
    reference: str | None = None,
    *,
    kept: DataFrame | None = None,
    keep_unmatched: bool = True,
) -> DataFrame:
    """Normal moves paired on the transaction id, dummy moves strictly by scan sequence.

    The window comes before the numbering; the reference filter comes after it. ``kept``, from :func:`sorting_legs` with
    the same window, is read in place of the ledger.
    """
    every = _sorting_legs(ledger, start, end) if kept is None else kept
    pairs = _pairs(every, reference, keep_unmatched, strict="goods = 'DUMMY'")
    dummy = F.col("goods") == "DUMMY"
    three_step = codes.ean_three_step(F.col("article"), F.col("document_ean"), F.col("target_article"))
    own = {name: F.when(dummy, F.col(name)) for name in IN_COLUMNS if name != "target_carrier"}
    return pairs.withColumns(own).withColumn("article", F.when(dummy, three_step).otherwise(F.col("article")))


def movement_report(moves: DataFrame, rules: MovementRules) -> DataFrame:
    """Completed moves in the report's 14 columns, codes as labels."""

    def looked_up(name: str) -> Column:
        own = F.col(name)
        return F.coalesce(F.col(f"target_{name}"), own) if rules.completion_first else own

    source, goods = looked_up("source_id"), F.col("goods")
    quality = F.col("quality_id")
    return completed_moves(moves, "source_carrier", "target_carrier").select(
        event_time_label(F.col("created")).alias("Timestamp"),
        F.col("article").alias("EAN"),
        F.col("destination").alias("AP"),
        F.col("created_by").alias("BENUTZER"),
        F.col("source_carrier").alias("Source_LHM"),
        F.col("target_carrier").alias("ZIEL_LHM"),
        F.abs("quantity").alias("Quantity"),
        F.col("reference").alias("Reference_LHM"),
        codes.decode_codes(source, codes.SOURCE_LABELS, rules.unknown_source).alias("Source_Channel"),
        codes.decode_codes(quality, codes.QUALITY_LABELS, "Unknown").alias("Quality"),
        codes.decode_codes(F.col("category_id"), codes.CATEGORY_LABELS, "Unknown").alias("Category"),
        codes.distribution_channel(
            F.col("target_carrier"),
            quality,
            looked_up("channel_id"),
            source if rules.completion_first else None,
        ).alias("Distribution_Channel"),
        codes.by_goods_type(goods, F.col("sku"), F.col("target_sku")).alias("SKU"),
        codes.by_goods_type(goods, F.col("sort_id"), F.col("target_sort_id")).alias("SORT_ID"),
    )


def overstock_report(
    ledger: DataFrame,
    start: str | None = None,
    end: str | None = None,
    reference: str | None = None,
    *,
    kept: DataFrame | None = None,
) -> DataFrame:
    """One row per matched (book-out, book-in) of the overstock area."""
    moves = overstock_movements(ledger, start, end, reference, kept=kept, keep_unmatched=False)
    return movement_report(moves, OVERSTOCK_RULES)


def manual_sorting_report(
    ledger: DataFrame,
    start: str | None = None,
    end: str | None = None,
    reference: str | None = None,
    *,
    kept: DataFrame | None = None,
) -> DataFrame:
    """One row per matched pair of the manual sorting area."""
    moves = manual_sorting_movements(ledger, start, end, reference, kept=kept, keep_unmatched=False)
    return movement_report(moves, MANUAL_SORTING_RULES)
