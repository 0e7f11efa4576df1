"""String predicates with the null rules of the ledger database."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# LIKE in the source dialect has no escape character, Spark's always has one. A control character
# keeps backslashes and tildes in the data literal.
LIKE_ESCAPE = "\u0001"


def blank_to_null(value: Column) -> Column:
    """The ledger database stores the empty string as NULL (blanks are kept)."""
    return F.nullif(value, F.lit(""))


def like(value: Column, pattern: Column) -> Column:
    """``value LIKE pattern`` without an escape character; the pattern may be a column."""
    return F.like(value, pattern, F.lit(LIKE_ESCAPE))


def not_prefixed(value: Column, prefix: str) -> Column:
    """``value NOT LIKE 'prefix%'``: NULL for NULL, so a filter drops the row."""
    return ~value.startswith(prefix)


def all_digits(value: Column) -> Column:
    """Only digits, at least one. ``\\z`` and not ``$``: Java's ``$`` also matches before a final newline."""
    return value.rlike(r"^[0-9]+\z")


def reference_predicate(reference: Column, text: str | None) -> Column | None:
    """Predicate of the multi-mode reference filter, or ``None`` for no filter.

    The text is a parameter, so the modes are chosen here and only the needed comparisons reach
    the plan. ``%`` in the text means wildcard, a comma means list, neither means exact; with both,
    wildcard and list apply together. Everything ignores case.

    In list mode the *data* is the pattern (``,list,`` LIKE ``%,reference,%``). References without
    a wildcard or comma reduce to membership, and only the others pay for a per-row pattern.
    """
    if not text:
        return None
    wanted = F.upper(F.lit(text))
    found = F.upper(reference)
    modes = []
    if "%" in text:
        modes.append(like(found, wanted))
    if "," in text:
        known = F.coalesce(found, F.lit(""))
        special = known.contains("%") | known.contains("_") | known.contains(",")
        by_pattern = like(
            F.concat(F.lit(","), wanted, F.lit(",")), F.concat(F.lit("%,"), known, F.lit(",%"))
        )
        members = [F.upper(F.lit(part)) for part in text.split(",")]
        modes.append(F.when(special, by_pattern).otherwise(known.isin(*members)))
    if not modes:
        modes.append(found == wanted)
    predicate = modes[0]
    for mode in modes[1:]:
        predicate = predicate | mode
    return predicate
