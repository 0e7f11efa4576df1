"""Entry points of the checks: the flagship query, all registered queries, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

import oracle_queries
from oracle_queries import REF_EXACT, REF_LIST, REF_WILDCARD, WINDOW
from tallyline.functions import codes
from tallyline.functions.calendar import event_time_label, month_label, month_label_padded, month_start
from tallyline.functions.json_fields import with_json_fields, with_variant_fields
from tallyline.functions.ratios import safe_ratio
from tallyline.functions.text import not_prefixed
from tallyline.operators.aggregates import ratio_of_sums, share_of_total
from tallyline.operators.legs import DOCUMENT_FIELDS, LEG_COLUMNS, completed_moves, leg_attributes, legs, ref_filter, window_filter
from tallyline.operators.lookups import decode_by_table, ref_filter_by_table
from tallyline.operators.numbering import sequence_number
from tallyline.operators.pairing import pair_bucketed_by_sequence, pair_by_sequence, pair_by_txn
from tallyline.operators.ranking import table_preview
from tallyline.plans import kpi_reports as kpi, kpi_states, ledger_reports as moves, sql_functions
from tallyline.session import scratch_path
from tallyline.sources import layouts, sample_tables as tables
from tallyline.sources.readers import read_csv, read_csv_checked, read_ledger, read_trip_table, write_csv
from tallyline.sources.schemas import TRIP_TABLES

Query = Callable[[SparkSession, str], DataFrame]


def _plain(result: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text: the clients of the two engines render these alike."""
    casts = {T.DecimalType: "double", T.DateType: "string", T.TimestampNTZType: "string"}
    return result.select(
        *[F.col(f.name).cast(casts[type(f.dataType)]).alias(f.name) if type(f.dataType) in casts else f.name for f in result.schema]
    )


# --- KPI --------------------------------------------------------------------------------------


def _trips_and_cities(report) -> Query:
    return lambda spark, sf: report(tables.fact_trips(spark, sf), tables.dim_city(spark, sf))


def _sums_and_cities(report, *others) -> Query:
    """On kept sums: those of most trips, to which the late third was added."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        trips, path = tables.fact_trips(spark, sf), scratch_path(spark, "trip-sums")
        late = F.col("driver_rating") % 3 == 0
        kpi_states.create_sums(trips.filter(~late), path)
        kpi_states.add_trips(trips.filter(late), path)
        return report(kpi_states.read_sums(spark, path), tables.dim_city(spark, sf), *[other(spark, sf) for other in others])

    return run


def _summary_and_cities(report) -> Query:
    return lambda spark, sf: report(tables.fact_passenger_summary(spark, sf), tables.dim_city(spark, sf))


def _csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "passenger-summary")
    write_csv(tables.fact_passenger_summary(spark, sf), path)
    return read_csv(spark, path, TRIP_TABLES["fact_passenger_summary"])


def _fares_of_read_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The fare summary on tables read with their declared schemas, one from Parquet and one from CSV."""
    trips, cities = scratch_path(spark, "fact-trips"), scratch_path(spark, "dim-city")
    tables.fact_trips(spark, sf).write.parquet(trips)
    write_csv(tables.dim_city(spark, sf), cities)
    return kpi.city_fare_summary(read_trip_table(spark, "fact_trips", trips), read_trip_table(spark, "dim_city", cities, "csv"))


def _ratio_of_sums(spark: SparkSession, sf: str) -> DataFrame:
    """Fare of all trips per km of the best-rated drivers; no such driver gives NULL."""
    trips = tables.fact_trips(spark, sf).withColumn(
        "km", F.when(F.col("driver_rating") > 6, F.col("distance_travelled_km")).otherwise(0)
    )
    sums = ratio_of_sums(trips, ["city_id", "passenger_type"], fare="fare_amount", km="km")
    return sums.select("city_id", "passenger_type", safe_ratio(F.col("fare"), F.col("km")).alias("fare_per_km"))


def _by_month(label=None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        months = tables.fact_trips(spark, sf).groupBy(month_start(F.col("trip_date")).alias("month"))
        counts = months.agg(F.count(F.lit(1)).alias("trips"))
        return counts if label is None else counts.withColumn("label", label(F.col("month")))

    return run


# --- ledger -----------------------------------------------------------------------------------


def _on_ledger(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: query(tables.ledger(spark, sf))


def _on_fields(query: Callable[[DataFrame], DataFrame], *fields: str) -> Query:
    """On all ledger rows with some document fields, whatever leg they belong to."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = tables.ledger(spark, sf).withColumnsRenamed(LEG_COLUMNS)
        return query(leg_attributes(rows, fields))

    return run


def _all_legs(ledger: DataFrame) -> DataFrame:
    def of(report: str, rules: moves.MovementRules) -> DataFrame:
        return legs(ledger, rules.normal_out, rules.normal_in, rules.dummy_out, rules.dummy_in).select(
            F.lit(report).alias("report"), "goods", "side", "txn", "sequence", "destination", "carrier", "article", "quantity"
        )

    return of("overstock", moves.OVERSTOCK_RULES).unionByName(of("sorting", moves.MANUAL_SORTING_RULES))


def _legs_of_read_ledger(ledger: DataFrame) -> DataFrame:
    path = scratch_path(ledger.sparkSession, "ledger")
    ledger.write.parquet(path)
    return _all_legs(read_ledger(ledger.sparkSession, path))


def _json_values(ledger: DataFrame) -> DataFrame:
    documents = ledger.select(F.col("SEQUENCE").alias("sequence"), "CUST_DATA")
    return with_json_fields(documents, "CUST_DATA", DOCUMENT_FIELDS).drop("CUST_DATA")


def _prefixes(ledger: DataFrame) -> DataFrame:
    kept = ledger.filter(not_prefixed(F.col("LHMNR"), "000") & F.col("ZIEL").startswith("OV"))
    return kept.select(F.col("SEQUENCE").alias("sequence"), F.col("LHMNR").alias("carrier"), F.col("ZIEL").alias("destination"))


def _event_labels(name: str, *window: str) -> Callable[[DataFrame], DataFrame]:
    def run(ledger: DataFrame) -> DataFrame:
        rows = window_filter(ledger, "CREATED", *window) if window else ledger
        return rows.select(F.col("SEQUENCE").alias("sequence"), event_time_label(F.col("CREATED")).alias(name))

    return run


def _references(text: str | None) -> Query:
    return _on_fields(lambda rows: ref_filter(rows.select("sequence", "reference"), "reference", text), "reference")


def _decoded(field: str, labels: dict, name: str) -> Query:
    return _on_fields(
        lambda rows: rows.select(
            "sequence", F.col(field).alias("code"), codes.decode_codes(F.col(field), labels, "Unknown").alias(name)
        ),
        field,
    )


def _channels(rows: DataFrame) -> DataFrame:
    operands = [F.col(c) for c in ("carrier", "quality_id", "channel_id", "source_id")]
    return rows.select(
        "sequence",
        codes.distribution_channel(*operands).alias("with_source_rule"),
        codes.distribution_channel(*operands[:3]).alias("without_source_rule"),
    )


def _goods_attributes(ledger: DataFrame) -> DataFrame:
    pick = lambda name: codes.by_goods_type(F.col("goods"), F.col(name), F.col(f"target_{name}")).alias(name)
    return moves.overstock_movements(ledger).select(
        "txn", "goods", event_time_label(F.col("created")).alias("created"), "target_carrier", pick("sku"), pick("sort_id")
    )


def _ean_three_step(ledger: DataFrame) -> DataFrame:
    return moves.manual_sorting_movements(ledger).filter("goods = 'DUMMY'").select(
        "txn", event_time_label(F.col("created")).alias("created"), "source_carrier", "target_carrier", F.col("article").alias("ean")
    )


def _dummy_sorting_legs(ledger: DataFrame) -> DataFrame:
    rules = moves.MANUAL_SORTING_RULES
    return legs(ledger, rules.dummy_out, rules.dummy_in)


def _sequence_numbers(ledger: DataFrame) -> DataFrame:
    rows = _dummy_sorting_legs(ledger).select("txn", "side", "sequence")
    return sequence_number(rows, ["txn", "side"], "sequence", ties=["sequence"])


def _sequence_number_ties(ledger: DataFrame) -> DataFrame:
    """Eight sequences at a time become one: the numbers of equal ones follow no column, their set is fixed."""
    rows = _dummy_sorting_legs(ledger).select("txn", "side", F.floor(F.col("sequence") / 64).alias("sequence"))
    return sequence_number(rows, ["txn", "side"], "sequence", ties=["sequence"])


def _kept(build, report) -> Callable[[DataFrame], DataFrame]:
    """A report on its legs as a written table."""

    def run(ledger: DataFrame) -> DataFrame:
        path = scratch_path(ledger.sparkSession, "kept-legs")
        build(ledger).write.parquet(path)
        return report(ledger, kept=ledger.sparkSession.read.parquet(path))

    return run


_PAIR = ["txn", "created", "source_carrier", "article", "target_carrier", "target_article"]


def _pairs_by_txn(ledger: DataFrame) -> DataFrame:
    rules = moves.OVERSTOCK_RULES
    outs = legs(ledger, rules.dummy_out).select("txn", "created", F.col("carrier").alias("source_carrier"), "article")
    ins = legs(ledger, rules.dummy_in).select(
        "txn", F.col("carrier").alias("target_carrier"), F.col("article").alias("target_article")
    )
    return _with_time_label(pair_by_txn(outs, ins, ["txn"]))


_STRICT_COLUMNS = {
    "out_columns": ["created", "source_carrier", "article"],
    "in_columns": ["target_carrier", "target_article"],
}


def _strict_legs(ledger: DataFrame) -> DataFrame:
    return _dummy_sorting_legs(ledger).withColumns(
        {"source_carrier": F.col("carrier"), "target_carrier": F.col("carrier"), "target_article": F.col("article")}
    )


def _pairs_by_sequence(ledger: DataFrame) -> DataFrame:
    return _with_time_label(pair_by_sequence(_strict_legs(ledger), ["txn"], "sequence", **_STRICT_COLUMNS))


# Buckets of the written ledger; one for each core or some more is a good number.
_BUCKETS = 8


def _pairs_of_bucketed_ledger(ledger: DataFrame) -> DataFrame:
    bucketed = layouts.write_bucketed_ledger(ledger, scratch_path(ledger.sparkSession, "bucketed-ledger"), _BUCKETS)
    return _with_time_label(pair_bucketed_by_sequence(bucketed, _strict_legs, ["txn"], "sequence", **_STRICT_COLUMNS))


def _on_variants(query: Callable[[DataFrame], DataFrame]) -> Query:
    """On the ledger written with parsed documents and read again."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        path = scratch_path(spark, "ledger-with-variants")
        layouts.write_ledger_with_variants(tables.ledger(spark, sf), path)
        return query(layouts.read_ledger_with_variants(spark, path))

    return run


def _by_sql(call: str) -> Query:
    """A report called by its SQL table function."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        sql_functions.register_reports(tables.ledger(spark, sf))
        return spark.sql(f"SELECT * FROM {call}")

    return run


def _variant_values(ledger: DataFrame) -> DataFrame:
    documents = ledger.select(F.col("SEQUENCE").alias("sequence"), "CUST_DATA")
    return with_variant_fields(documents, "CUST_DATA", DOCUMENT_FIELDS).drop("CUST_DATA")


def _variant_fields(ledger: DataFrame) -> DataFrame:
    rows = leg_attributes(ledger.withColumnsRenamed(LEG_COLUMNS))
    return rows.select("sequence", *DOCUMENT_FIELDS.values())


def _decoded_by_table(rows: DataFrame) -> DataFrame:
    """Categories by a table of codes, one of them there twice; joined by shuffle, as a large table is."""
    pairs = [(i, code, label) for i, (code, label) in enumerate([*codes.CATEGORY_LABELS.items(), ("1", "again"), (None, "none")])]
    values = ", ".join(f"({i}, {'NULL' if code is None else repr(code)}, {label!r})" for i, code, label in pairs)
    table = rows.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(position, code, label)")
    decoded = decode_by_table(rows, "category_id", table, default="Unknown", name="category", broadcast_codes=0)
    return decoded.select("sequence", F.col("category_id").alias("code"), "category")


def _references_by_table(rows: DataFrame) -> DataFrame:
    values = ", ".join(f"({i}, {text!r})" for i, text in enumerate(REF_LIST.split(",")))
    listed = rows.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(position, reference)")
    return ref_filter_by_table(rows.select("sequence", "reference"), "reference", listed)


# Lines of every seventh city have a text for a number, those of every eleventh a column too many.
_SUMMARY_LINE = """concat_ws(',', month, city_id, IF(CAST(city_id AS INT) % 7 = 3, 'n/a', CAST(new_passengers AS STRING)), repeat_passengers,
    total_passengers, IF(CAST(city_id AS INT) % 11 = 5, 'more', NULL))"""


def _checked_summary(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The passenger summary as CSV with bad lines, read again: what fits, and what does not."""
    path = scratch_path(spark, "summary-with-bad-lines")
    schema = TRIP_TABLES["fact_passenger_summary"]
    header = spark.createDataFrame([(0, ",".join(schema.names))], "place int, line string")
    lines = header.unionByName(tables.fact_passenger_summary(spark, sf).selectExpr("1 AS place", f"{_SUMMARY_LINE} AS line"))
    lines.repartition(1).sortWithinPartitions("place").select("line").write.text(path)
    return read_csv_checked(spark, path, schema)


def _on_ledger_by_day(query: Callable[[DataFrame], DataFrame]) -> Query:
    """On the ledger written by day and read again."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        path = scratch_path(spark, "ledger-by-day")
        layouts.write_ledger_by_day(tables.ledger(spark, sf), path)
        return query(layouts.read_ledger_by_day(spark, path))

    return run


def _with_time_label(pairs: DataFrame) -> DataFrame:
    return pairs.select(*_PAIR).withColumn("created", event_time_label(F.col("created")))


def _union(build) -> Query:
    columns = [
        "txn", "goods", "created", "article", "destination", "created_by", "source_carrier", "target_carrier",
        "quantity", "reference", "sku", "target_sku",
    ]
    return _on_ledger(lambda ledger: build(ledger).select(*columns).withColumn("created", event_time_label(F.col("created"))))


def _completed(pairs: DataFrame) -> DataFrame:
    return completed_moves(pairs, "source_carrier", "target_carrier")


def _registered() -> dict[str, Query]:
    return {
        "table_preview": lambda spark, sf: table_preview(tables.fact_trips(spark, sf), 10, ["trip_id"]),
        "preview_dim_city": lambda spark, sf: table_preview(tables.dim_city(spark, sf)),
        "preview_monthly_target_trips": lambda spark, sf: table_preview(tables.monthly_target_trips(spark, sf)),
        "preview_repeat_trip_distribution": lambda spark, sf: table_preview(tables.dim_repeat_trip_distribution(spark, sf)),
        "preview_monthly_target_new_passengers": lambda spark, sf: table_preview(tables.monthly_target_new_passengers(spark, sf)),
        "preview_passenger_summary": lambda spark, sf: table_preview(tables.fact_passenger_summary(spark, sf)),
        "csv_roundtrip": _csv_roundtrip,
        "city_fare_summary": _trips_and_cities(kpi.city_fare_summary),
        "city_fare_summary_read": _fares_of_read_tables,
        "ratio_of_sums": _ratio_of_sums,
        "share_of_total": lambda spark, sf: share_of_total(tables.fact_trips(spark, sf), "city_id"),
        "month_bucket": _by_month(),
        "month_label": _by_month(month_label),
        "month_label_padded": _by_month(month_label_padded),
        "target_variance": lambda spark, sf: kpi.target_variance(
            tables.fact_trips(spark, sf), tables.dim_city(spark, sf), tables.monthly_target_trips(spark, sf)
        ),
        "repeat_distribution": lambda spark, sf: kpi.repeat_distribution(
            tables.dim_repeat_trip_distribution(spark, sf), tables.dim_city(spark, sf)
        ),
        "top_bottom_groups": _summary_and_cities(kpi.top_bottom_cities),
        "top_bottom_fixed_bands": _summary_and_cities(kpi.top_bottom_cities_fixed),
        "peak_month_share": _trips_and_cities(kpi.peak_month_share),
        "peak_month_share_int": _trips_and_cities(kpi.peak_month_share_int),
        "repeat_rate": _trips_and_cities(kpi.repeat_rate),
        "city_fare_summary_kept": _sums_and_cities(kpi_states.city_fare_summary),
        "target_variance_kept": _sums_and_cities(kpi_states.target_variance, tables.monthly_target_trips),
        "peak_month_share_kept": _sums_and_cities(kpi_states.peak_month_share),
        "repeat_rate_kept": _sums_and_cities(kpi_states.repeat_rate),
        "ledger_legs": _on_ledger(_all_legs),
        "ledger_legs_read": _on_ledger(_legs_of_read_ledger),
        "json_value": _on_ledger(_json_values),
        "json_value_variant": _on_variants(_variant_values),
        "json_fields_variant": _on_variants(_variant_fields),
        "manual_sorting_report_variant": _on_variants(moves.manual_sorting_report),
        "overstock_report_variant": _on_variants(moves.overstock_report),
        "decode_by_table": _on_fields(_decoded_by_table, "category_id"),
        "ref_filter_by_table": _on_fields(_references_by_table, "reference"),
        "city_rank": _summary_and_cities(kpi.ranked_cities),
        "day_rank": lambda spark, sf: kpi.ranked_days(tables.fact_trips(spark, sf)),
        "csv_checked_rows": lambda spark, sf: _checked_summary(spark, sf)[0],
        "csv_rejected_rows": lambda spark, sf: _checked_summary(spark, sf)[1].drop("file"),
        "json_fields": _on_fields(
            lambda rows: rows.select("sequence", *DOCUMENT_FIELDS.values()), *DOCUMENT_FIELDS.values()
        ),
        "like_prefix_filter": _on_ledger(_prefixes),
        "optional_time_window": _on_ledger(_event_labels("created", *WINDOW)),
        "ref_filter_none": _references(None),
        "ref_filter_wildcard": _references(REF_WILDCARD),
        "ref_filter_list": _references(REF_LIST),
        "ref_filter_exact": _references(REF_EXACT),
        "decode_source": _decoded("source_id", codes.SOURCE_LABELS, "source_channel"),
        "decode_quality": _decoded("quality_id", codes.QUALITY_LABELS, "quality"),
        "decode_category": _decoded("category_id", codes.CATEGORY_LABELS, "category"),
        "distribution_channel": _on_fields(_channels, "quality_id", "channel_id", "source_id"),
        "sku_by_goods_type": _on_ledger(_goods_attributes),
        "ean_two_step": _on_fields(
            lambda rows: rows.select(
                "sequence", "article", codes.ean_two_step(F.col("article"), F.col("document_ean")).alias("ean")
            ),
            "document_ean",
        ),
        "ean_three_step": _on_ledger(_ean_three_step),
        "event_time_label": _on_ledger(_event_labels("label")),
        "sequence_number": _on_ledger(_sequence_numbers),
        "sequence_number_ties": _on_ledger(_sequence_number_ties),
        "completed_moves": _on_ledger(
            lambda ledger: _completed(moves.overstock_movements(ledger)).select(
                "txn", "goods", event_time_label(F.col("created")).alias("created"), "source_carrier", "target_carrier"
            )
        ),
        "pair_by_txn": _on_ledger(_pairs_by_txn),
        "pair_by_txn_completed": _on_ledger(lambda ledger: _completed(_pairs_by_txn(ledger))),
        "pair_by_sequence": _on_ledger(_pairs_by_sequence),
        "pair_by_sequence_bucketed": _on_ledger(_pairs_of_bucketed_ledger),
        "optional_time_window_by_day": _on_ledger_by_day(_event_labels("created", *WINDOW)),
        "manual_sorting_report_by_day": _on_ledger_by_day(
            lambda ledger: moves.manual_sorting_report(ledger, *WINDOW, REF_WILDCARD)
        ),
        "movement_union": _union(moves.overstock_movements),
        "movement_union_strict": _union(moves.manual_sorting_movements),
        "overstock_report": _on_ledger(moves.overstock_report),
        "overstock_report_sql": _by_sql("overstock_report()"),
        "manual_sorting_report_sql": _by_sql(
            f"manual_sorting_report(ref_lhm_filter => '{REF_WILDCARD}', start_datetime => '{WINDOW[0]}', end_datetime => '{WINDOW[1]}')"
        ),
        "overstock_report_filtered": _on_ledger(lambda ledger: moves.overstock_report(ledger, *WINDOW, REF_WILDCARD)),
        "manual_sorting_report": _on_ledger(moves.manual_sorting_report),
        "manual_sorting_report_kept": _on_ledger(_kept(moves.sorting_legs, moves.manual_sorting_report)),
        "overstock_report_kept": _on_ledger(_kept(moves.overstock_legs, moves.overstock_report)),
        "manual_sorting_report_filtered": _on_ledger(
            lambda ledger: moves.manual_sorting_report(ledger, *WINDOW, REF_WILDCARD)
        ),
    }


def _training_data() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the training-data operators, if their subpackage is there."""
    try:
        import corpus_pipeline
        from tallyline.llm import queries as llm
    except ModuleNotFoundError as missing:
        if missing.name in ("corpus_pipeline", "tallyline.llm"):
            return {}, {}
        raise
    pipeline_sql = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return llm.queries() | {"pipeline": corpus_pipeline.run}, llm.oracle_sql() | pipeline_sql


def queries() -> dict[str, Query]:
    """Every registered query; each takes (spark, sf_dir)."""
    own = {name: (lambda spark, sf, query=query: _plain(query(spark, sf))) for name, query in _registered().items()}
    return own | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    """The same results in DuckDB's SQL."""
    return oracle_queries.oracle_sql() | _training_data()[1]


def entry(spark: SparkSession) -> DataFrame:
    """The manual-sorting report on the smallest tables."""
    return queries()["manual_sorting_report"](spark, "/root/testdata/sf0.001")
