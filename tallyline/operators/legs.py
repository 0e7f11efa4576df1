"""Selecting the legs of a move from the ledger and reading their attributes."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from tallyline.functions.calendar import DAY_COLUMN, event_time, window_predicate
from tallyline.functions.json_fields import with_json_fields, with_variant_fields
from tallyline.functions.text import all_digits, reference_predicate

# Transaction kinds of the ledger.
NORMAL_MOVE = 520
DUMMY_OUT = 614
DUMMY_IN = 207

# JSON key of the document -> column of a leg.
DOCUMENT_FIELDS = {
    "REFERENCENUMBER_LHM": "reference",
    "LASTEANGOTFROMMAUS_ZIEL": "document_ean",
    "SOURCEID_SEKTOR": "source_id",
    "QUALITYID_SEKTOR": "quality_id",
    "CATEGORYID_ART": "category_id",
    "DISTRIBUTIONCHANNELID_ART": "channel_id",
    "SKU_ART": "sku",
    "SORTINGCRITERIAID_ART": "sort_id",
}


_SIGNS = {"negative": "< 0", "one": "= 1", "positive": "> 0"}


@dataclass(frozen=True)
class LegSpec:
    """One leg: transaction kind and sign of the quantity, and optional further conditions."""

    kind: int
    quantity: str  # "negative", "one" or "positive"
    locations: tuple[str, ...] = ()
    destination_prefix: str | None = None
    destinations: tuple[str, ...] = ()
    subtype: int | None = None
    excluded_carrier_prefix: str | None = None

    def condition(self) -> str:
        """The leg as a SQL condition on the ledger's columns."""
        parts = [f"TPARTNR = {self.kind}", f"MENGE {_SIGNS[self.quantity]}"]
        if self.locations:
            parts.append(f"LAGBEZ IN {_texts(self.locations)}")
        if self.destination_prefix:
            parts.append(f"startswith(ZIEL, {_text(self.destination_prefix)})")
        if self.destinations:
            parts.append(f"ZIEL IN {_texts(self.destinations)}")
        if self.subtype is not None:
            parts.append(f"TYP_ID = {self.subtype}")
        if self.excluded_carrier_prefix:
            parts.append(f"NOT startswith(LHMNR, {_text(self.excluded_carrier_prefix)})")
        return "(" + " AND ".join(parts) + ")"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _texts(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(map(_text, values)) + ")"


# Ledger column -> column of a leg.
LEG_COLUMNS = {
    "LOCAL_TRANSACTION_ID": "txn",
    "SEQUENCE": "sequence",
    "CREATED": "created",
    "CREATEDBY": "created_by",
    "ARTNR": "article",
    "ZIEL": "destination",
    "LHMNR": "carrier",
    "MENGE": "quantity",
    "CUST_DATA": "document",
}


_READ_AS = {"ZIEL": "nullif(ZIEL, '')"}


def legs(ledger: DataFrame, *specs: LegSpec) -> DataFrame:
    """The rows of any of the legs, from one scan, tagged with ``side`` and ``goods``.

    The legs of a report differ in kind and sign, so both tags follow from these two columns. An
    empty destination is NULL, like other empty texts, but only after the filter: the comparisons reach the scan.
    """
    return ledger.filter(" OR ".join(spec.condition() for spec in specs)).selectExpr(
        *[f"{_READ_AS.get(column, column)} AS {name}" for column, name in LEG_COLUMNS.items()],
        "IF(MENGE < 0, 'OUT', 'IN') AS side",
        f"IF(TPARTNR = {NORMAL_MOVE}, 'NORMAL', 'DUMMY') AS goods",
    )


def leg_attributes(rows: DataFrame, fields: Collection[str] = tuple(DOCUMENT_FIELDS.values())) -> DataFrame:
    """Legs with the document, a text or a VARIANT, replaced by the given fields: narrow rows to shuffle."""
    wanted = {key: name for key, name in DOCUMENT_FIELDS.items() if name in fields}
    read = with_variant_fields if has_variants(rows) else with_json_fields
    return read(rows, "document", wanted).drop("document")


def has_variants(rows: DataFrame) -> bool:
    """Whether the legs' documents are parsed already."""
    return isinstance(rows.schema["document"].dataType, T.VariantType)


def window_filter(rows: DataFrame, column: str, start: str | None, end: str | None) -> DataFrame:
    """Closed time window, or all rows if there is no start.

    Of a ledger partitioned by day only the days of the window are read.
    """
    inside = window_predicate(F.col(column), start, end)
    if inside is None:
        return rows
    if column == "CREATED" and DAY_COLUMN in rows.columns and end:
        first, last = F.to_date(event_time(start)), F.to_date(event_time(end))
        inside = F.col(DAY_COLUMN).between(first, last) & inside
    return rows.filter(inside)


def ref_filter(rows: DataFrame, column: str, text: str | None) -> DataFrame:
    """Rows whose reference meets the filter text: none, wildcard, comma list or exact."""
    wanted = reference_predicate(F.col(column), text)
    return rows if wanted is None else rows.filter(wanted)


def completed_moves(rows: DataFrame, source: str, target: str) -> DataFrame:
    """Moves that ended on another carrier with a purely numeric id.

    An unknown source differs from every target; a NULL target is never numeric.
    """
    return rows.filter(~F.col(source).eqNullSafe(F.col(target)) & all_digits(F.col(target)))
