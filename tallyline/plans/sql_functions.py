"""The movement reports as SQL table functions with named parameters that may be NULL or left out.

``SELECT * FROM manual_sorting_report(start_datetime => '05.01.2024 06:00:00', end_datetime => '21.01.2024 18:30:00')``

The functions read the legs of a ledger and match them as :func:`match_legs` does, in one exchange and in cells. A parameter that
is NULL leaves no condition in the plan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tallyline.functions import codes
from tallyline.functions.calendar import EVENT_TIME_FORMAT
from tallyline.operators.matching import CELL_ROWS
from tallyline.operators.numbering import order_cell
from tallyline.plans.ledger_reports import (
    IN_COLUMNS,
    KEYS,
    MANUAL_SORTING_RULES,
    OUT_COLUMNS,
    OVERSTOCK_RULES,
    MovementRules,
    overstock_legs,
    sorting_legs,
)

_PARAMETERS = "start_datetime STRING DEFAULT NULL, end_datetime STRING DEFAULT NULL, ref_lhm_filter STRING DEFAULT NULL"
_RESULT = """Timestamp STRING, EAN STRING, AP STRING, BENUTZER STRING, Source_LHM STRING, ZIEL_LHM STRING, Quantity INT, Reference_LHM STRING,
    Source_Channel STRING, Quality STRING, Category STRING, Distribution_Channel STRING, SKU STRING, SORT_ID STRING"""
_WINDOW = f"""(coalesce(start_datetime, '') = ''
    OR created BETWEEN to_timestamp_ntz(nullif(start_datetime, ''), '{EVENT_TIME_FORMAT}') AND to_timestamp_ntz(nullif(end_datetime, ''), '{EVENT_TIME_FORMAT}'))"""
# LIKE has no escape character there; a control character is none that occurs.
_REFERENCE = """(coalesce(ref_lhm_filter, '') = ''
    OR instr(ref_lhm_filter, '%') > 0 AND like(upper(reference), upper(ref_lhm_filter), '\\u0001')
    OR instr(ref_lhm_filter, ',') > 0
        AND like(concat(',', upper(ref_lhm_filter), ','), concat('%,', coalesce(upper(reference), ''), ',%'), '\\u0001')
    OR instr(ref_lhm_filter, '%') = 0 AND instr(ref_lhm_filter, ',') = 0 AND upper(reference) = upper(ref_lhm_filter))"""


def _decode(code: str, labels: Mapping[str, str], default: str) -> str:
    return f"CASE {code} " + " ".join(f"WHEN '{key}' THEN '{label}'" for key, label in labels.items()) + f" ELSE '{default}' END"


def _channel(rules: MovementRules, channel: str, source: str) -> str:
    by_source = f"WHEN {source} = '11' THEN 'Overstock' " if rules.completion_first else ""
    return (
        "CASE WHEN startswith(target_carrier, '50') THEN 'Overstock' WHEN quality_id IN ('3', '4') THEN 'Overstock' "
        f"WHEN {channel} = '4' THEN 'Outlet' WHEN {channel} = '3' THEN 'Overstock' {by_source}ELSE 'Unknown' END"
    )


def _body(view: str, legs: DataFrame, rules: MovementRules, window: str, strict: str) -> str:
    held = [c for c in legs.columns if c not in (*KEYS, "side")]
    names = ", ".join(f"`{c}`" for c in held)
    cell = order_cell(legs, KEYS, "sequence", f"xxhash64({names})")
    of_key = "PARTITION BY " + ", ".join(f"_cell.{key}" for key in KEYS)
    earlier = f"{of_key} ORDER BY _cell._slice NULLS LAST, _cell._part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    count = lambda side: f"count(CASE WHEN _side = '{side}' THEN struct(_leg, _strict) END)"
    keys = ", ".join(f"_cell.{key} AS {key}" for key in KEYS)
    partner = ", ".join(f"_leg.{source} AS {name}" for name, source in IN_COLUMNS.items())
    outs = ", ".join(f"_leg.{source} AS {name}" for name, source in OUT_COLUMNS.items())
    ins = ", ".join(f"_in.{name} AS {name}" for name in IN_COLUMNS)
    first = (lambda name: f"coalesce(target_{name}, {name})") if rules.completion_first else (lambda name: name)
    source, channel = first("source_id"), first("channel_id")
    two_step = "CASE WHEN NOT startswith(article, '2') THEN document_ean ELSE article END"
    three_step = (
        "CASE WHEN startswith(article, '2') THEN article WHEN document_ean IS NOT NULL THEN document_ean "
        "WHEN startswith(target_article, '2') THEN target_article ELSE article END"
    )
    ean = two_step if rules.completion_first else three_step
    day = "concat_ws('.', substr(at, 9, 2), substr(at, 6, 2), substr(at, 1, 4))"
    return f"""
WITH cells AS (
  SELECT /*+ REPARTITION(_cell) */ * FROM (
    SELECT {cell} AS _cell, side AS _side, struct({names}) AS _leg, {strict} AS _strict
    FROM {view} WHERE txn IS NOT NULL AND {window})),
sizes AS (SELECT _cell, {count('OUT')} AS _cell_outs, {count('IN')} AS _cell_ins FROM cells GROUP BY _cell),
offsets AS (
  SELECT _cell, coalesce(sum(_cell_outs) OVER ({earlier}), 0) AS _outs_before, coalesce(sum(_cell_ins) OVER ({earlier}), 0) AS _ins_before,
    sum(_cell_outs) OVER ({of_key}) AS _outs, sum(_cell_ins) OVER ({of_key}) AS _ins
  FROM sizes),
own AS (SELECT *, row_number() OVER (PARTITION BY _cell, _side ORDER BY _leg.sequence NULLS LAST, xxhash64(_leg), _leg) AS _own FROM cells),
numbered AS (
  SELECT _cell, _side, _leg, _strict, _own + IF(_side = 'OUT', _outs_before, _ins_before) AS _rn, IF(_side = 'OUT', _ins, _outs) AS _others
  FROM own JOIN offsets USING (_cell)),
matched AS (
  SELECT * FROM (SELECT *, _leg.reference AS reference FROM numbered WHERE IF(_strict, _rn <= _others, _others > 0))
  WHERE _side = 'IN' OR {_REFERENCE}),
placed AS (
  SELECT _cell, _side, _leg, IF(_strict, _rn, (_rn - 1) div {CELL_ROWS}) AS _own,
    explode(IF(_strict, array(_rn), sequence(0L, (_others - 1) div {CELL_ROWS}))) AS _other
  FROM matched),
meetings AS (
  SELECT struct({keys}, IF(_side = 'OUT', _own, _other) AS _row, IF(_side = 'OUT', _other, _own) AS _column) AS _meeting, _side, _leg FROM placed),
met AS (
  SELECT *, collect_list(IF(_side = 'IN', struct({partner}), NULL)) OVER (PARTITION BY _meeting) AS _partners FROM meetings),
pairs AS (SELECT _meeting, _leg, explode(_partners) AS _in FROM met WHERE _side = 'OUT'),
moves AS (SELECT _meeting.goods AS goods, {outs}, {ins}, CAST(_leg.created AS STRING) AS at FROM pairs)
SELECT concat({day}, ' ', substr(at, 12, 8)), IF(goods = 'DUMMY', {ean}, article), destination, created_by, source_carrier, target_carrier,
  abs(quantity), reference, {_decode(source, codes.SOURCE_LABELS, rules.unknown_source)},
  {_decode('quality_id', codes.QUALITY_LABELS, 'Unknown')}, {_decode('category_id', codes.CATEGORY_LABELS, 'Unknown')},
  {_channel(rules, channel, source)}, IF(goods = 'NORMAL', sku, target_sku), IF(goods = 'NORMAL', sort_id, target_sort_id)
FROM moves WHERE NOT source_carrier <=> target_carrier AND rlike(target_carrier, '^[0-9]+\\\\z')"""


def register_reports(ledger: DataFrame) -> None:
    """Makes ``overstock_report`` and ``manual_sorting_report`` temporary table functions of the session, on this ledger.

    Their legs are the temporary views ``overstock_report_legs`` and ``manual_sorting_report_legs``.
    """
    spark = ledger.sparkSession
    overstock, sorting = overstock_legs(ledger), sorting_legs(ledger)
    overstock.createOrReplaceTempView("overstock_report_legs")
    sorting.createOrReplaceTempView("manual_sorting_report_legs")
    # The window holds for book-outs only, or for every leg before it is numbered.
    bodies = {
        "overstock_report": _body("overstock_report_legs", overstock, OVERSTOCK_RULES, f"(side = 'IN' OR {_WINDOW})", "false"),
        "manual_sorting_report": _body("manual_sorting_report_legs", sorting, MANUAL_SORTING_RULES, _WINDOW, "goods = 'DUMMY'"),
    }
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({_PARAMETERS}) RETURNS TABLE({_RESULT}) RETURN {body}")
