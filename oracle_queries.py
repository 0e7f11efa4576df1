"""DuckDB twins of the registered queries, on the same Parquet tables."""

from __future__ import annotations

WINDOW = ("05.01.2024 06:00:00", "21.01.2024 18:30:00")
REF_WILDCARD, REF_LIST, REF_EXACT = "ref1%", "REF12,ref7,REF31", "ref7"

# --- inputs -----------------------------------------------------------------------------------

TRIPS = """
trips AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS trip_id,
         CAST(l_shipdate AS DATE) AS trip_date,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
         CAST(l_partkey % 27 AS VARCHAR) AS city_id,
         CASE WHEN l_returnflag = 'R' THEN 'repeated' ELSE 'new' END AS passenger_type,
         CAST(l_quantity AS BIGINT) AS km,
         CAST(floor(l_extendedprice) AS BIGINT) AS fare,
         CAST(l_suppkey % 10 + 1 AS INTEGER) AS passenger_rating,
         l_linenumber AS driver_rating
  FROM lineitem)"""
CITIES = "cities AS (SELECT CAST(n_nationkey AS VARCHAR) AS city_id, n_name AS city_name FROM nation)"
NATION_MONTH = """
nation_month AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(c_nationkey AS VARCHAR) AS city_id,
         count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""
DISTRIBUTION = """
distribution AS (
  SELECT month, CAST(c_nationkey AS VARCHAR) AS city_id, n || '-Trips' AS trip_count,
         CAST(count(*) AS INTEGER) AS repeat_passenger_count
  FROM (SELECT o_custkey, count(*) AS n, CAST(date_trunc('year', min(o_orderdate)) AS DATE) AS month
        FROM orders GROUP BY 1 HAVING count(*) >= 2) p
  JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)"""
SUMMARY = """
visits AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
summary AS (
  SELECT v.month, CAST(c_nationkey AS VARCHAR) AS city_id,
         CAST(count(*) FILTER (WHERE v.month = f.month) AS INTEGER) AS new_passengers,
         CAST(count(*) FILTER (WHERE v.month > f.month) AS INTEGER) AS repeat_passengers,
         CAST(count(*) AS INTEGER) AS total_passengers
  FROM visits v JOIN (SELECT o_custkey, min(month) AS month FROM visits GROUP BY 1) f USING (o_custkey)
  JOIN customer ON v.o_custkey = c_custkey GROUP BY 1, 2)"""
LEDGER = """
src AS (SELECT *, event_id AS e, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
ledger AS (
  SELECT CASE WHEN e % 53 <> 0 THEN 'T' || (e // 8) END AS txn,
         e AS seq,
         CASE event_type WHEN 'click' THEN 614 WHEN 'purchase' THEN 207 WHEN 'signup' THEN 520
                         WHEN 'view' THEN 520 ELSE 999 END AS kind,
         CASE WHEN e % 10 = 3 THEN 110 ELSE 120 END AS subtype,
         CAST(CASE event_type WHEN 'click' THEN -1
                              WHEN 'purchase' THEN CASE WHEN e % 19 = 0 THEN 2 ELSE 1 END
                              WHEN 'signup' THEN -1 - e % 3 WHEN 'view' THEN 1 ELSE 0 END AS INTEGER) AS qty,
         CASE WHEN e % 7 = 0 THEN 'Sorter' WHEN e % 7 <= 3 THEN 'Overstock' ELSE 'SZROV' END AS loc,
         CASE WHEN e % 29 = 0 THEN NULL WHEN e % 5 <= 1 THEN 'OV' || (e % 12)
              WHEN e % 5 <= 3 THEN 'IN_SZR_OV' ELSE 'SZR_OV' END AS dest,
         CASE WHEN e % 17 = 0 THEN NULL WHEN e % 13 = 0 THEN 'LHM-' || (e % 6) WHEN e % 11 = 0 THEN '50' || (e % 6)
              WHEN e % 9 = 0 THEN '000' || (e % 6) ELSE '4' || (e % 6) END AS carrier,
         CASE WHEN e % 31 = 0 THEN NULL WHEN e % 3 = 0 THEN '9' || (e % 1000) ELSE '2' || (e % 1000) END AS article,
         ts AS created,
         'U' || user_id AS created_by,
         CASE WHEN e % 47 = 0 THEN NULL WHEN e % 41 = 0 THEN 'no document' ELSE
           '{"REFERENCENUMBER_LHM":"' || CASE WHEN e % 37 = 0 THEN 'REF_' || (e % 10) ELSE 'REF' || (e % 40) END || '",'
           || CASE WHEN e % 4 <> 0 THEN '"LASTEANGOTFROMMAUS_ZIEL":"' || (2000000 + e % 5000) || '",' ELSE '' END
           || '"SOURCEID_SEKTOR":' || CASE WHEN e % 23 = 0 THEN '{"id":1}' WHEN k % 4 = 0 THEN '"1"'
                WHEN k % 4 = 1 THEN '"10"' WHEN k % 4 = 2 THEN '"11"' ELSE 'null' END
           || ',"QUALITYID_SEKTOR":' || (k % 6)
           || ',"CATEGORYID_ART":"' || (k % 7)
           || '","DISTRIBUTIONCHANNELID_ART":"' || CASE WHEN k % 5 = 0 THEN '' ELSE CAST(k % 5 AS VARCHAR) END
           || '","SKU_ART":"SKU' || (e % 500)
           || '","SORTINGCRITERIAID_ART":"' || (k % 9) || CASE WHEN e % 59 = 0 THEN '","SKU_ART":"again' ELSE '' END || '"}'
           || CASE WHEN e % 61 = 0 THEN ' text' WHEN e % 67 = 0 THEN '{"SKU_ART":"next"}' ELSE '' END END AS doc
  FROM src)"""


_SOUND = "CASE WHEN json_valid(doc) THEN CASE WHEN len(json_keys(doc)) = len(list_distinct(json_keys(doc))) THEN doc END END"


def _json(key: str) -> str:
    return f"NULLIF(json_value(sound, '$.{key}') ->> '$', '')"


_FIELDS = {
    "reference": "REFERENCENUMBER_LHM",
    "document_ean": "LASTEANGOTFROMMAUS_ZIEL",
    "source_id": "SOURCEID_SEKTOR",
    "quality_id": "QUALITYID_SEKTOR",
    "category_id": "CATEGORYID_ART",
    "channel_id": "DISTRIBUTIONCHANNELID_ART",
    "sku": "SKU_ART",
    "sort_id": "SORTINGCRITERIAID_ART",
}
FIELDS = (
    LEDGER
    + f",\nsound_ledger AS (SELECT *, {_SOUND} AS sound FROM ledger),\nfields AS (SELECT *, "
    + ", ".join(f"{_json(k)} AS {n}" for n, k in _FIELDS.items())
    + " FROM sound_ledger)"
)


# --- expressions ------------------------------------------------------------------------------


def _ratio(a: str, b: str, factor: int = 1) -> str:
    """a / b * factor, two decimals, half away from zero, by integer arithmetic."""
    scaled = 2 * factor * 100
    return (
        f"CAST(sign({a}) * (({scaled} * abs({a}) + NULLIF({b}, 0)) // (2 * NULLIF({b}, 0))) AS DOUBLE) / 100"
    )


def _time(text: str) -> str:
    return f"strptime('{text}', '%d.%m.%Y %H:%M:%S')"


def _inside(column: str) -> str:
    return f"{column} BETWEEN {_time(WINDOW[0])} AND {_time(WINDOW[1])}"


def _label(column: str) -> str:
    return f"strftime({column}, '%d.%m.%Y %H:%M:%S')"


def _ref_list(column: str) -> str:
    return f"',' || upper('{REF_LIST}') || ',' LIKE '%,' || coalesce(upper({column}), '') || ',%'"


def _source(code: str, default: str) -> str:
    return f"CASE {code} WHEN '1' THEN 'Zalando SE' WHEN '10' THEN 'OSR' WHEN '11' THEN 'OSR (OV)' ELSE '{default}' END"


def _quality(code: str) -> str:
    return f"CASE {code} WHEN '1' THEN 'A' WHEN '2' THEN 'B' WHEN '3' THEN 'C' WHEN '4' THEN 'D' ELSE 'Unknown' END"


def _category(code: str) -> str:
    return (
        f"CASE {code} WHEN '1' THEN 'Schuhe' WHEN '2' THEN 'Textil' WHEN '3' THEN 'ACC' WHEN '4' THEN 'Home' "
        "WHEN '5' THEN 'Beauty' ELSE 'Unknown' END"
    )


def _channel(carrier: str, quality: str, channel: str, source: str | None = None) -> str:
    extra = f"WHEN {source} = '11' THEN 'Overstock' " if source else ""
    return (
        f"CASE WHEN {carrier} LIKE '50%' THEN 'Overstock' WHEN {quality} IN ('3', '4') THEN 'Overstock' "
        f"WHEN {channel} = '4' THEN 'Outlet' WHEN {channel} = '3' THEN 'Overstock' {extra}ELSE 'Unknown' END"
    )


def _ean3(article: str, document: str, target: str) -> str:
    return (
        f"CASE WHEN {article} LIKE '2%' THEN {article} WHEN {document} IS NOT NULL THEN {document} "
        f"WHEN {target} LIKE '2%' THEN {target} ELSE {article} END"
    )


# --- ledger relations -------------------------------------------------------------------------

_AREA = "loc IN ('Overstock', 'SZROV')"
_SORT = "dest IN ('IN_SZR_OV', 'SZR_OV')"
OV_N1 = f"kind = 520 AND qty < 0 AND {_AREA} AND dest LIKE 'OV%'"
OV_N2 = f"kind = 520 AND {_AREA} AND qty = 1 AND carrier NOT LIKE '000%'"
OV_D1 = f"kind = 614 AND qty < 0 AND {_AREA} AND dest LIKE 'OV%'"
OV_D2 = f"kind = 207 AND {_AREA} AND qty = 1 AND dest LIKE 'OV%'"
MS_N1 = f"kind = 520 AND qty < 0 AND {_SORT}"
MS_N2 = f"kind = 520 AND {_SORT} AND qty = 1"
MS_D1 = "kind = 614 AND subtype = 120 AND qty < 0 AND dest = 'IN_SZR_OV'"
MS_D2 = f"kind = 207 AND {_SORT} AND qty > 0"

_UNION_COLUMNS = """t1.txn, t1.created, t1.dest, t1.created_by, t1.carrier AS source_carrier, t2.carrier AS target_carrier,
  t1.qty, t1.reference, t1.source_id, t1.quality_id, t1.category_id, t1.channel_id, t1.sku, t1.sort_id"""


def _overstock_moves(t1_filter: str = "TRUE") -> str:
    t2 = "t2.source_id AS source_id2, t2.channel_id AS channel_id2, t2.sku AS sku2, t2.sort_id AS sort_id2"
    return f"""{FIELDS},
moves AS (
  SELECT {_UNION_COLUMNS}, 'NORMAL' AS goods, t1.article AS ean, {t2}
  FROM (SELECT * FROM fields WHERE {OV_N1}) t1
  LEFT JOIN (SELECT * FROM fields WHERE {OV_N2}) t2 ON t1.txn = t2.txn
  WHERE {t1_filter}
  UNION ALL
  SELECT {_UNION_COLUMNS}, 'DUMMY',
         CASE WHEN t1.article NOT LIKE '2%' THEN t1.document_ean ELSE t1.article END, {t2}
  FROM (SELECT * FROM fields WHERE {OV_D1}) t1
  LEFT JOIN (SELECT * FROM fields WHERE {OV_D2}) t2 ON t1.txn = t2.txn
  WHERE {t1_filter} AND t2.carrier NOT LIKE '000%')"""


def _sorting_moves(leg_filter: str = "TRUE", t1_filter: str = "TRUE") -> str:
    rn = "row_number() OVER (PARTITION BY txn ORDER BY seq ASC NULLS LAST) AS rn"
    return f"""{FIELDS},
d1 AS (SELECT *, {rn} FROM fields WHERE {MS_D1} AND {leg_filter}),
d2 AS (SELECT *, {rn} FROM fields WHERE {MS_D2} AND {leg_filter}),
moves AS (
  SELECT {_UNION_COLUMNS}, 'NORMAL' AS goods, t1.article AS ean, NULL AS sku2, NULL AS sort_id2
  FROM (SELECT * FROM fields WHERE {MS_N1} AND {leg_filter}) t1
  LEFT JOIN (SELECT * FROM fields WHERE {MS_N2} AND {leg_filter}) t2 ON t1.txn = t2.txn
  WHERE {t1_filter}
  UNION ALL
  SELECT {_UNION_COLUMNS}, 'DUMMY', {_ean3('t1.article', 't1.document_ean', 't2.article')}, t2.sku, t2.sort_id
  FROM d1 t1 LEFT JOIN d2 t2 ON t1.txn = t2.txn AND t1.rn = t2.rn
  WHERE {t1_filter})"""


_COMPLETED = "source_carrier IS DISTINCT FROM target_carrier AND regexp_full_match(target_carrier, '[0-9]+')"


def _report(moves: str, source: str, default: str, channel: str) -> str:
    return f"""WITH {moves}
SELECT {_label('created')} AS "Timestamp", ean AS "EAN", dest AS "AP", created_by AS "BENUTZER",
  source_carrier AS "Source_LHM", target_carrier AS "ZIEL_LHM", abs(qty) AS "Quantity", reference AS "Reference_LHM",
  {_source(source, default)} AS "Source_Channel", {_quality('quality_id')} AS "Quality",
  {_category('category_id')} AS "Category", {channel} AS "Distribution_Channel",
  CASE goods WHEN 'NORMAL' THEN sku WHEN 'DUMMY' THEN sku2 END AS "SKU",
  CASE goods WHEN 'NORMAL' THEN sort_id WHEN 'DUMMY' THEN sort_id2 END AS "SORT_ID"
FROM moves WHERE {_COMPLETED}"""


def _overstock(t1_filter: str = "TRUE") -> str:
    source = "coalesce(source_id2, source_id)"
    channel = _channel("target_carrier", "quality_id", "coalesce(channel_id2, channel_id)", source)
    return _report(_overstock_moves(t1_filter), source, "Unknown", channel)


def _sorting(leg_filter: str = "TRUE", t1_filter: str = "TRUE") -> str:
    channel = _channel("target_carrier", "quality_id", "channel_id")
    return _report(_sorting_moves(leg_filter, t1_filter), "source_id", "Zircle", channel)


_MOVE_COLUMNS = f"""txn, goods, {_label('created')} AS created, ean AS article, dest AS destination, created_by,
  source_carrier, target_carrier, qty AS quantity, reference, sku, sku2 AS target_sku"""
_PAIR = f"""t1.txn, {_label('t1.created')} AS created, t1.carrier AS source_carrier, t1.article AS article,
  t2.carrier AS target_carrier, t2.article AS target_article"""
_LEG = "txn, seq AS sequence, dest AS destination, carrier, article, qty AS quantity"


def _legs(report: str, spec: str, goods: str, side: str) -> str:
    return f"SELECT '{report}' AS report, '{goods}' AS goods, '{side}' AS side, {_LEG} FROM ledger WHERE {spec}"


_REVENUE = f"""{TRIPS}, {CITIES},
revenue AS (
  SELECT city_name, month, CAST(sum(fare) AS BIGINT) AS revenue,
         rank() OVER (PARTITION BY city_name ORDER BY sum(fare) DESC NULLS FIRST) AS r
  FROM trips JOIN cities USING (city_id) GROUP BY 1, 2),
total AS (SELECT city_name, CAST(sum(fare) AS BIGINT) AS total FROM trips JOIN cities USING (city_id) GROUP BY 1)"""
_NEW_TOTALS = f"""{SUMMARY}, {CITIES},
totals AS (SELECT city_name, CAST(sum(new_passengers) AS BIGINT) AS total_new_passengers
           FROM summary JOIN cities USING (city_id) GROUP BY 1),
ranked AS (SELECT *, rank() OVER (ORDER BY total_new_passengers DESC NULLS FIRST) AS down,
                  rank() OVER (ORDER BY total_new_passengers ASC NULLS LAST) AS up FROM totals)"""


def oracle_sql() -> dict[str, str]:
    buckets = ", ".join(
        _ratio(f"sum(CASE WHEN trip_count = '{n}-Trips' THEN repeat_passenger_count ELSE 0 END)", "sum(repeat_passenger_count)", 100)
        + f" AS trips_{n}"
        for n in range(2, 11)
    )
    ref = f"WITH {FIELDS} SELECT seq AS sequence, reference FROM fields"
    filtered = f"upper(t1.reference) LIKE upper('{REF_WILDCARD}')"
    month_rows = f"WITH {TRIPS} SELECT CAST(month AS VARCHAR) AS month, count(*) AS trips{{label}} FROM trips GROUP BY month"
    kpi = {
        "table_preview": f"""WITH {TRIPS} SELECT trip_id, CAST(trip_date AS VARCHAR) AS trip_date, city_id, passenger_type,
            CAST(km AS DOUBLE) AS distance_travelled_km, CAST(fare AS INTEGER) AS fare_amount, passenger_rating, driver_rating
            FROM trips ORDER BY 1, trips.trip_date, 3, 4, km, fare, 7, 8 LIMIT 10""",
        "preview_dim_city": f"WITH {CITIES} SELECT * FROM cities",
        "preview_monthly_target_trips": f"""WITH {NATION_MONTH} SELECT CAST(month AS VARCHAR) AS month, city_id,
            CAST(4 * n AS INTEGER) AS total_target_trips FROM nation_month""",
        "preview_repeat_trip_distribution": f"""WITH {DISTRIBUTION} SELECT CAST(month AS VARCHAR) AS month, city_id,
            trip_count, repeat_passenger_count FROM distribution""",
        "preview_monthly_target_new_passengers": f"""WITH {NATION_MONTH} SELECT CAST(month AS VARCHAR) AS month, city_id,
            CAST(n // 2 AS INTEGER) AS target_new_passengers FROM nation_month""",
        "preview_passenger_summary": f"""WITH {SUMMARY} SELECT CAST(month AS VARCHAR) AS month, city_id, new_passengers,
            repeat_passengers, total_passengers FROM summary""",
        "csv_roundtrip": f"""WITH {SUMMARY} SELECT CAST(month AS VARCHAR) AS month, city_id, new_passengers,
            repeat_passengers, total_passengers FROM summary""",
        "city_fare_summary": f"""WITH {TRIPS}, {CITIES}, g AS (
            SELECT city_name, count(*) AS n, sum(fare) AS fare, count(fare) AS fares, sum(km) AS km
            FROM trips JOIN cities USING (city_id) GROUP BY 1)
            SELECT city_name, n AS total_trips, {_ratio('fare', 'km')} AS avg_fare_per_km,
              CAST((2 * fare + fares) // (2 * fares) AS DOUBLE) AS avg_fare_per_trip,
              {_ratio('n', '(SELECT count(*) FROM trips)', 100)} AS percentage_contribution_to_total_trips
            FROM g ORDER BY n DESC, city_name""",
        "ratio_of_sums": f"""WITH {TRIPS}, g AS (
            SELECT city_id, passenger_type, sum(fare) AS fare, sum(CASE WHEN driver_rating > 6 THEN km ELSE 0 END) AS km
            FROM trips GROUP BY 1, 2)
            SELECT city_id, passenger_type, {_ratio('fare', 'km')} AS fare_per_km FROM g""",
        "share_of_total": f"""WITH {TRIPS}, g AS (SELECT city_id, count(*) AS n FROM trips GROUP BY 1)
            SELECT city_id, n AS "rows", {_ratio('n', '(SELECT count(*) FROM trips)', 100)} AS percentage FROM g""",
        "month_bucket": month_rows.format(label=""),
        "month_label": month_rows.format(label=", strftime(month, '%B') AS label"),
        "month_label_padded": month_rows.format(label=", rpad(strftime(month, '%B'), 9, ' ') AS label"),
        "target_variance": f"""WITH {TRIPS}, {CITIES}, {NATION_MONTH},
            cm AS (SELECT month, city_id, city_name, count(*) AS a FROM trips JOIN cities USING (city_id) GROUP BY 1, 2, 3),
            g AS (SELECT city_name, cm.month AS month, CAST(sum(a) AS BIGINT) AS a, CAST(sum(4 * n) AS BIGINT) AS t
                  FROM cm JOIN nation_month nm ON cm.city_id = nm.city_id AND cm.month = nm.month GROUP BY 1, 2)
            SELECT city_name, rpad(strftime(month, '%B'), 9, ' ') AS month_name, a AS actual_trips, t AS target_trips,
              CASE WHEN a > t THEN 'Above Target' ELSE 'Below Target' END AS performance_status,
              {_ratio('(a - t)', 't', 100)} AS percentage_difference
            FROM g ORDER BY city_name, month""",
        "repeat_distribution": f"""WITH {DISTRIBUTION}, {CITIES}
            SELECT city_name, {buckets} FROM distribution JOIN cities USING (city_id) GROUP BY city_name""",
        "top_bottom_groups": f"""WITH {_NEW_TOTALS} SELECT city_name, total_new_passengers,
            CASE WHEN down <= 3 THEN 'Top 3' ELSE 'Bottom 3' END AS city_category FROM ranked WHERE down <= 3 OR up <= 3""",
        "top_bottom_fixed_bands": f"""WITH {_NEW_TOTALS} SELECT city_name, total_new_passengers,
            CASE WHEN down BETWEEN 1 AND 3 THEN 'Top 3' ELSE 'Bottom 3' END AS city_category
            FROM ranked WHERE down BETWEEN 1 AND 3 OR down BETWEEN 8 AND 10""",
        "peak_month_share": f"""WITH {_REVENUE} SELECT city_name, strftime(month, '%B') AS highest_revenue_month, revenue,
            {_ratio('revenue', 'total', 100)} AS percentage_contribution
            FROM revenue JOIN total USING (city_name) WHERE r = 1 ORDER BY city_name""",
        "peak_month_share_int": f"""WITH {_REVENUE} SELECT city_name, strftime(month, '%B') AS highest_revenue_month, revenue,
            CAST(revenue // total * 100 AS BIGINT) AS percentage_contribution
            FROM revenue JOIN total USING (city_name) WHERE r = 1 ORDER BY city_name""",
        "repeat_rate": f"""WITH {TRIPS}, {CITIES}, m AS (
            SELECT city_name, month, count(*) AS n, count(*) FILTER (WHERE passenger_type = 'repeated') AS r
            FROM trips JOIN cities USING (city_id) GROUP BY 1, 2),
            c AS (SELECT city_name, sum(n) AS n, sum(r) AS r FROM m GROUP BY 1)
            SELECT city_name, rpad(strftime(m.month, '%B'), 9, ' ') AS month, m.n AS total_passengers,
              m.r AS repeat_passengers, {_ratio('m.r', 'm.n', 100)} AS monthly_repeat_passenger_rate,
              {_ratio('c.r', 'c.n', 100)} AS city_repeat_passenger_rate
            FROM m JOIN c USING (city_name) ORDER BY city_name, m.month""",
    }
    leg_union = " UNION ALL ".join(
        _legs(*parts)
        for parts in [
            ("overstock", OV_N1, "NORMAL", "OUT"), ("overstock", OV_N2, "NORMAL", "IN"),
            ("overstock", OV_D1, "DUMMY", "OUT"), ("overstock", OV_D2 + " AND carrier NOT LIKE '000%'", "DUMMY", "IN"),
            ("sorting", MS_N1, "NORMAL", "OUT"), ("sorting", MS_N2, "NORMAL", "IN"),
            ("sorting", MS_D1, "DUMMY", "OUT"), ("sorting", MS_D2, "DUMMY", "IN"),
        ]
    )
    kpi["city_fare_summary_read"] = kpi["city_fare_summary"]
    ledger = {
        "ledger_legs": f"WITH {LEDGER} {leg_union}",
        "ledger_legs_read": f"WITH {LEDGER} {leg_union}",
        "json_value": f"WITH {FIELDS} SELECT seq AS sequence, {', '.join(_FIELDS)} FROM fields",
        "json_fields": f"WITH {FIELDS} SELECT seq AS sequence, {', '.join(_FIELDS)} FROM fields",
        "like_prefix_filter": f"""WITH {LEDGER} SELECT seq AS sequence, carrier, dest AS destination FROM ledger
            WHERE carrier NOT LIKE '000%' AND dest LIKE 'OV%'""",
        "optional_time_window": f"WITH {LEDGER} SELECT seq AS sequence, {_label('created')} AS created FROM ledger WHERE {_inside('created')}",
        "ref_filter_none": ref,
        "ref_filter_wildcard": f"{ref} WHERE upper(reference) LIKE upper('{REF_WILDCARD}')",
        "ref_filter_list": f"{ref} WHERE {_ref_list('reference')}",
        "ref_filter_exact": f"{ref} WHERE upper(reference) = upper('{REF_EXACT}')",
        "decode_source": f"""WITH {FIELDS} SELECT seq AS sequence, source_id AS code,
            {_source('source_id', 'Unknown')} AS source_channel FROM fields""",
        "decode_quality": f"WITH {FIELDS} SELECT seq AS sequence, quality_id AS code, {_quality('quality_id')} AS quality FROM fields",
        "decode_category": f"WITH {FIELDS} SELECT seq AS sequence, category_id AS code, {_category('category_id')} AS category FROM fields",
        "distribution_channel": f"""WITH {FIELDS} SELECT seq AS sequence,
            {_channel('carrier', 'quality_id', 'channel_id', 'source_id')} AS with_source_rule,
            {_channel('carrier', 'quality_id', 'channel_id')} AS without_source_rule FROM fields""",
        "sku_by_goods_type": f"""WITH {_overstock_moves()} SELECT txn, goods, {_label('created')} AS created, target_carrier,
            CASE goods WHEN 'NORMAL' THEN sku ELSE sku2 END AS sku,
            CASE goods WHEN 'NORMAL' THEN sort_id ELSE sort_id2 END AS sort_id FROM moves""",
        "ean_two_step": f"""WITH {FIELDS} SELECT seq AS sequence, article,
            CASE WHEN article NOT LIKE '2%' THEN document_ean ELSE article END AS ean FROM fields""",
        "ean_three_step": f"""WITH {_sorting_moves()} SELECT txn, {_label('created')} AS created, source_carrier, target_carrier, ean
            FROM moves WHERE goods = 'DUMMY'""",
        "event_time_label": f"WITH {LEDGER} SELECT seq AS sequence, {_label('created')} AS label FROM ledger",
        "sequence_number": f"""WITH {LEDGER}, d AS (
            SELECT 'OUT' AS side, txn, seq FROM ledger WHERE {MS_D1} UNION ALL SELECT 'IN', txn, seq FROM ledger WHERE {MS_D2})
            SELECT txn, side, seq AS sequence,
              row_number() OVER (PARTITION BY txn, side ORDER BY seq ASC NULLS LAST) AS rn FROM d""",
        "sequence_number_ties": f"""WITH {LEDGER}, d AS (
            SELECT 'OUT' AS side, txn, seq // 64 AS seq FROM ledger WHERE {MS_D1} UNION ALL SELECT 'IN', txn, seq // 64 FROM ledger WHERE {MS_D2})
            SELECT txn, side, seq AS sequence,
              row_number() OVER (PARTITION BY txn, side ORDER BY seq ASC NULLS LAST) AS rn FROM d""",
        "completed_moves": f"WITH {_overstock_moves()} SELECT txn, goods, {_label('created')} AS created, source_carrier, target_carrier FROM moves WHERE {_COMPLETED}",
        "pair_by_txn": f"""WITH {LEDGER} SELECT {_PAIR} FROM (SELECT * FROM ledger WHERE {OV_D1}) t1
            LEFT JOIN (SELECT * FROM ledger WHERE {OV_D2} AND carrier NOT LIKE '000%') t2 ON t1.txn = t2.txn""",
        "pair_by_txn_completed": f"""WITH {LEDGER}, p AS (SELECT {_PAIR} FROM (SELECT * FROM ledger WHERE {OV_D1}) t1
            LEFT JOIN (SELECT * FROM ledger WHERE {OV_D2} AND carrier NOT LIKE '000%') t2 ON t1.txn = t2.txn)
            SELECT * FROM p WHERE {_COMPLETED}""",
        "pair_by_sequence": f"""WITH {LEDGER},
            t1 AS (SELECT *, row_number() OVER (PARTITION BY txn ORDER BY seq) AS rn FROM ledger WHERE {MS_D1}),
            t2 AS (SELECT *, row_number() OVER (PARTITION BY txn ORDER BY seq) AS rn FROM ledger WHERE {MS_D2})
            SELECT {_PAIR} FROM t1 LEFT JOIN t2 ON t1.txn = t2.txn AND t1.rn = t2.rn""",
        "movement_union": f"WITH {_overstock_moves()} SELECT {_MOVE_COLUMNS} FROM moves",
        "movement_union_strict": f"WITH {_sorting_moves()} SELECT {_MOVE_COLUMNS} FROM moves",
        "overstock_report": _overstock(),
        "overstock_report_kept": _overstock(),
        "overstock_report_filtered": _overstock(f"{_inside('t1.created')} AND {filtered}"),
        "manual_sorting_report": _sorting(),
        "manual_sorting_report_kept": _sorting(),
        "manual_sorting_report_filtered": _sorting(_inside("created"), filtered),
    }
    ledger["decode_by_table"] = f"""WITH {FIELDS} SELECT seq AS sequence, category_id AS code,
        CASE WHEN category_id IS NULL THEN 'none' ELSE {_category('category_id')} END AS category FROM fields"""
    ledger["ref_filter_by_table"] = ledger["ref_filter_list"]
    kpi["city_rank"] = f"""WITH {_NEW_TOTALS} SELECT city_name, total_new_passengers, down AS rank_from_top, up AS rank_from_bottom FROM ranked"""
    kpi["day_rank"] = f"""WITH {TRIPS}, d AS (SELECT trip_date, count(*) AS trips, CAST(max(fare) AS INTEGER) AS best_fare FROM trips GROUP BY 1)
        SELECT CAST(trip_date AS VARCHAR) AS trip_date, trips, best_fare, rank() OVER (ORDER BY trips DESC NULLS FIRST) AS trips_rank,
          rank() OVER (ORDER BY best_fare DESC NULLS FIRST) AS fare_rank FROM d"""
    bad = "(CAST(city_id AS INTEGER) % 7 = 3 OR CAST(city_id AS INTEGER) % 11 = 5)"
    kpi["csv_checked_rows"] = f"""WITH {SUMMARY} SELECT CAST(month AS VARCHAR) AS month, city_id, new_passengers,
        repeat_passengers, total_passengers FROM summary WHERE NOT {bad}"""
    kpi["csv_rejected_rows"] = f"""WITH {SUMMARY} SELECT concat_ws(',', month, city_id,
          CASE WHEN CAST(city_id AS INTEGER) % 7 = 3 THEN 'n/a' ELSE CAST(new_passengers AS VARCHAR) END, repeat_passengers, total_passengers,
          CASE WHEN CAST(city_id AS INTEGER) % 11 = 5 THEN 'more' END) AS line,
        CASE WHEN CAST(city_id AS INTEGER) % 7 = 3 THEN 'new_passengers is no int: n/a' ELSE 'number of columns' END AS reason FROM summary WHERE {bad}"""
    for name in ("city_fare_summary", "target_variance", "peak_month_share", "repeat_rate"):
        kpi[f"{name}_kept"] = kpi[name]
    ledger["overstock_report_sql"] = ledger["overstock_report"]
    ledger["manual_sorting_report_sql"] = ledger["manual_sorting_report_filtered"]
    # The same rows from other layouts of the ledger.
    for name in ("json_value", "json_fields", "manual_sorting_report", "overstock_report"):
        ledger[f"{name}_variant"] = ledger[name]
    ledger["pair_by_sequence_bucketed"] = ledger["pair_by_sequence"]
    ledger["optional_time_window_by_day"] = ledger["optional_time_window"]
    ledger["manual_sorting_report_by_day"] = ledger["manual_sorting_report_filtered"]
    return {**kpi, **ledger}
