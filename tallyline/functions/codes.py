"""Code tables and rule cascades."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Codes of the ledger's JSON document and their labels.
SOURCE_LABELS = {"1": "Zalando SE", "10": "OSR", "11": "OSR (OV)"}
QUALITY_LABELS = {"1": "A", "2": "B", "3": "C", "4": "D"}
CATEGORY_LABELS = {"1": "Schuhe", "2": "Textil", "3": "ACC", "4": "Home", "5": "Beauty"}


def decode_codes(code: Column, labels: Mapping[str | None, str], default: str | None) -> Column:
    """``DECODE(code, k1, v1, ..., default)``; a ``None`` key matches NULL."""
    cascade = None
    for key, label in labels.items():
        hit = code.eqNullSafe(F.lit(key))
        cascade = F.when(hit, F.lit(label)) if cascade is None else cascade.when(hit, F.lit(label))
    fallback = F.lit(default).cast("string")
    return fallback if cascade is None else cascade.otherwise(fallback)


def distribution_channel(
    target_carrier: Column, quality: Column, channel: Column, source: Column | None = None
) -> Column:
    """First hit wins; a NULL operand is no hit. ``source`` adds the rule on source 11."""
    rule = (
        F.when(target_carrier.startswith("50"), "Overstock")
        .when(quality.isin("3", "4"), "Overstock")
        .when(channel == "4", "Outlet")
        .when(channel == "3", "Overstock")
    )
    if source is not None:
        rule = rule.when(source == "11", "Overstock")
    return rule.otherwise("Unknown")


def by_goods_type(goods: Column, normal: Column, dummy: Column) -> Column:
    """Normal goods carry the attribute on the book-out, dummy goods on the book-in."""
    return F.when(goods == "NORMAL", normal).when(goods == "DUMMY", dummy)


def ean_two_step(article: Column, document_ean: Column) -> Column:
    """Article unless it lacks the leading 2; then the document's EAN, even if that is NULL."""
    return F.when(~article.startswith("2"), document_ean).otherwise(article)


def ean_three_step(article: Column, document_ean: Column, target_article: Column) -> Column:
    """Valid article, then the document's EAN, then a valid book-in article, then the article as is."""
    return (
        F.when(article.startswith("2"), article)
        .when(document_ean.isNotNull(), document_ean)
        .when(target_article.startswith("2"), target_article)
        .otherwise(article)
    )


def target_status(actual: Column, target: Column) -> Column:
    """Strictly greater is above; equal, smaller and unknown are below."""
    return F.when(actual > target, "Above Target").otherwise("Below Target")
