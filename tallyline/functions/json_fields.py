"""Scalar extraction from a JSON document column: one rule for all keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def sound_document(document: str) -> str:
    """SQL: the document, or NULL if it is malformed, has text behind it or a key twice.

    It is parsed as the one element of an array, so that trailing text is an error or a second element.
    """
    return f"CASE WHEN size(try_cast(try_parse_json(concat('[', `{document}`, ']')) AS array<variant>)) = 1 THEN `{document}` END"


def _scalar(raw: str, document: str, key: str) -> str:
    """SQL: ``raw``, the text of ``key`` as Spark extracts it, if it is a non-empty scalar.

    Spark's JSON functions return objects and arrays as text. Only text that looks like one is
    checked for its node type: a JSON *string* that begins with a brace is a scalar.
    """
    node = f"schema_of_variant(try_variant_get(try_parse_json(`{document}`), '$.{key}', 'variant'))"
    return (
        f"CASE WHEN startswith({raw}, '{{') OR startswith({raw}, '[') "
        f"THEN CASE WHEN NOT rlike({node}, '^(OBJECT|ARRAY)') THEN {raw} END ELSE nullif({raw}, '') END"
    )


def with_json_fields(rows: DataFrame, document: str, fields: Mapping[str, str]) -> DataFrame:
    """``JSON_VALUE(document, '$.key')`` as a column for each key of ``fields``.

    NULL for objects, arrays, JSON null, the empty string, a missing key, and every key of a document that is
    not sound. Fractional numbers come in Spark's notation (``1.50`` as ``1.5``); codes are integers or
    strings. All keys are read in one pass, and a later filter on them stays above it.
    """
    if not fields:
        return rows
    raw = {key: f"_raw_{name}" for key, name in fields.items()}
    columns = [f"`{column}`" for column in rows.columns]
    parsed = rows.select("*", F.json_tuple(F.expr(sound_document(document)), *raw).alias(*raw.values()))
    return parsed.selectExpr(*columns, *[f"{_scalar(raw[key], document, key)} AS `{name}`" for key, name in fields.items()])


def sound_variant(rows: DataFrame, document: str) -> DataFrame:
    """``rows`` with the document parsed once into a VARIANT, by the rule of :func:`sound_document`; NULL if it is not sound."""
    parsed = rows.withColumn("_parsed", F.expr(f"try_parse_json(concat('[', `{document}`, ']'))"))
    only = "CASE WHEN size(try_cast(_parsed AS array<variant>)) = 1 THEN try_variant_get(_parsed, '$[0]', 'variant') END"
    return parsed.withColumn(document, F.expr(only)).drop("_parsed")


def with_variant_fields(rows: DataFrame, document: str, fields: Mapping[str, str]) -> DataFrame:
    """The columns of :func:`with_json_fields` from a document that is stored as a VARIANT: nothing is parsed."""
    if not fields:
        return rows
    raw = {key: f"try_variant_get(`{document}`, '$.{key}', 'string')" for key in fields}
    found = rows.selectExpr("*", *[f"{raw[key]} AS `_raw_{name}`" for key, name in fields.items()])
    columns = [f"`{column}`" for column in rows.columns]

    def scalar(key: str, name: str) -> str:
        # A string that begins with a brace is a scalar, an object or array is none; both read as such a text.
        node = f"schema_of_variant(try_variant_get(`{document}`, '$.{key}', 'variant'))"
        text = f"`_raw_{name}`"
        nested = f"CASE WHEN NOT rlike({node}, '^(OBJECT|ARRAY)') THEN {text} END"
        return f"CASE WHEN startswith({text}, '{{') OR startswith({text}, '[') THEN {nested} ELSE nullif({text}, '') END AS `{name}`"

    return found.selectExpr(*columns, *[scalar(key, name) for key, name in fields.items()])
