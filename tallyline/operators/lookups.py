"""Lookups in tables: codes with their labels, and lists of references."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyline.functions.text import LIKE_ESCAPE

# A table of labels is broadcast if it has at most so many codes.
BROADCAST_CODES = 100_000


def _packed(rows: DataFrame) -> str:
    """SQL: all columns as one struct, whatever their names."""
    return "struct(" + ", ".join(f"`{c}`" for c in rows.columns) + ") AS _row"


def decode_by_table(
    rows: DataFrame,
    code: str,
    table: DataFrame,
    *,
    key: str = "code",
    label: str = "label",
    position: str = "position",
    default: str | None = None,
    name: str,
    broadcast_codes: int | None = None,
) -> DataFrame:
    """``DECODE(code, k1, v1, ..., default)`` with the pairs in a table: ``rows`` with a column ``name``.

    The first pair of a key by ``position`` wins, even if its label is NULL; a NULL key matches a NULL code; other codes get the ``default``. The codes are
    counted first, up to the limit: a table of at most ``broadcast_codes`` codes is broadcast, a larger one is joined by shuffle, where Spark
    splits codes that many rows share.
    """
    limit = BROADCAST_CODES if broadcast_codes is None else broadcast_codes
    pair = table.selectExpr(f"struct(CAST(`{key}` AS STRING) AS code) AS _code", f"struct(`{position}` AS place, CAST(`{label}` AS STRING) AS label) AS _pair")
    labels = pair.groupBy("_code").agg(F.expr("min(_pair).label AS _label"), F.expr("true AS _known"))
    if labels.limit(limit + 1).count() <= limit:
        labels = F.broadcast(labels)
    found = rows.selectExpr(_packed(rows), f"struct(CAST(`{code}` AS STRING) AS code) AS _code").join(labels, "_code", "left")
    fallback = "CAST(NULL AS STRING)" if default is None else "'" + default.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return found.selectExpr("_row.*", f"IF(_known, _label, {fallback}) AS `{name}`")


def ref_filter_by_table(rows: DataFrame, column: str, references: DataFrame, *, reference: str = "reference", position: str = "position") -> DataFrame:
    """The rows that the comma-list mode of the reference filter keeps, with the list in a table in the order of ``position``.

    As there, the *data* is the pattern: ``',list,' LIKE '%,' || reference || ',%'``, without regard to case, an unknown reference being empty.
    References without ``%``, ``_`` and commas are looked up by a join on the list's elements; the others are compared with the whole
    list, each distinct one once. The list is one text in that step, so it must stay below Spark's limit of 2 GB a value. A NULL in the list is empty.
    """
    listed = references.selectExpr(f"`{position}` AS _place", f"upper(coalesce(`{reference}`, '')) AS _element")
    text = listed.agg(F.sort_array(F.collect_list(F.struct("_place", "_element"))).alias("s")).selectExpr(
        "concat(',', array_join(transform(s, x -> x._element), ','), ',') AS t"
    )
    known = rows.selectExpr(_packed(rows), f"upper(coalesce(`{column}`, '')) AS _known")
    special = "(contains(_known, '%') OR contains(_known, '_') OR contains(_known, ','))"
    elements = listed.selectExpr("explode(split(_element, ',', -1)) AS _known").distinct()
    patterns = known.filter(special).select("_known").distinct().withColumn("_list", text.scalar())
    hits = patterns.filter(F.like(F.col("_list"), F.concat(F.lit("%,"), F.col("_known"), F.lit(",%")), F.lit(LIKE_ESCAPE))).select("_known")
    # Elements with a special character equal plain references never, and patterns are special: the two sets are apart.
    kept = elements.filter(f"NOT {special}").unionByName(hits)
    return known.join(kept, "_known", "left_semi").select("_row.*")
