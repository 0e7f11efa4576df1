"""The report inputs, derived from the test tables.

Trips come from line items, targets and passengers from orders and customers, cities from nations,
and the ledger from events. Everything is a projection or a pre-aggregated join, so the derivation
scales with its inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyline.sources.readers import as_ledger


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dim_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    return nation.select(F.col("n_nationkey").cast("string").alias("city_id"), F.col("n_name").alias("city_name"))


def fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """27 city ids against 25 cities: some trips have no city."""
    return _table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("trip_id"),
        F.to_date("l_shipdate").alias("trip_date"),
        (F.col("l_partkey") % 27).cast("string").alias("city_id"),
        F.when(F.col("l_returnflag") == "R", "repeated").otherwise("new").alias("passenger_type"),
        F.col("l_quantity").cast("decimal(18,2)").alias("distance_travelled_km"),
        F.floor("l_extendedprice").cast("int").alias("fare_amount"),
        (F.col("l_suppkey") % 10 + 1).cast("int").alias("passenger_rating"),
        F.col("l_linenumber").cast("int").alias("driver_rating"),
    )


def _orders_by_nation_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order counts per (city_id, month); customers join after the orders are counted per customer."""
    orders = _table(spark, sf_dir, "orders")
    customers = _table(spark, sf_dir, "customer")
    counted = orders.groupBy("o_custkey", F.trunc(F.to_date("o_orderdate"), "month").alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        counted.join(customers, counted.o_custkey == customers.c_custkey)
        .groupBy("month", F.col("c_nationkey").cast("string").alias("city_id"))
        .agg(F.sum("n").alias("n"))
    )


def monthly_target_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _orders_by_nation_month(spark, sf_dir)
    return counts.select("month", "city_id", (F.col("n") * 4).cast("int").alias("total_target_trips"))


def monthly_target_new_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _orders_by_nation_month(spark, sf_dir)
    return counts.select(
        "month", "city_id", F.call_function("div", F.col("n"), F.lit(2)).cast("int").alias("target_new_passengers")
    )


def dim_repeat_trip_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with two or more orders by number of orders, under the year of their first order."""
    orders = _table(spark, sf_dir, "orders")
    customers = _table(spark, sf_dir, "customer")
    per_customer = (
        orders.groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("n"), F.trunc(F.to_date(F.min("o_orderdate")), "year").alias("month"))
        .filter("n >= 2")
    )
    return (
        per_customer.join(customers, per_customer.o_custkey == customers.c_custkey)
        .groupBy(
            "month",
            F.col("c_nationkey").cast("string").alias("city_id"),
            F.concat(F.col("n").cast("string"), F.lit("-Trips")).alias("trip_count"),
        )
        .agg(F.count(F.lit(1)).cast("int").alias("repeat_passenger_count"))
    )


def fact_passenger_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordering customers per city and month: new in the month of their first order, else repeat."""
    orders = _table(spark, sf_dir, "orders")
    customers = _table(spark, sf_dir, "customer")
    active = orders.select("o_custkey", F.trunc(F.to_date("o_orderdate"), "month").alias("month")).distinct()
    first_month = F.min("month").over(Window.partitionBy("o_custkey"))
    is_new = (F.col("month") == F.col("first_month")).cast("int")
    return (
        active.withColumn("first_month", first_month)
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("month", F.col("c_nationkey").cast("string").alias("city_id"))
        .agg(
            F.sum(is_new).cast("int").alias("new_passengers"),
            F.sum(1 - is_new).cast("int").alias("repeat_passengers"),
            F.count(F.lit(1)).cast("int").alias("total_passengers"),
        )
    )


# Eight consecutive events are one transaction. Event types give kind and sign; remainders of the
# event id give locations, destinations, carriers and articles with all the special cases (NULL,
# empty, prefixes, non-numeric).
_LEDGER_COLUMNS = {
    "LOCAL_TRANSACTION_ID": "CASE WHEN event_id % 53 != 0 THEN concat('T', event_id DIV 8) END",
    "SEQUENCE": "event_id",
    "TPARTNR": """CASE event_type WHEN 'click' THEN 614 WHEN 'purchase' THEN 207
                  WHEN 'signup' THEN 520 WHEN 'view' THEN 520 ELSE 999 END""",
    "TYP_ID": "IF(event_id % 10 = 3, 110, 120)",
    "MENGE": """CASE event_type WHEN 'click' THEN -1 WHEN 'purchase' THEN IF(event_id % 19 = 0, 2, 1)
                WHEN 'signup' THEN -1 - event_id % 3 WHEN 'view' THEN 1 ELSE 0 END""",
    "LAGBEZ": "CASE WHEN event_id % 7 = 0 THEN 'Sorter' WHEN event_id % 7 <= 3 THEN 'Overstock' ELSE 'SZROV' END",
    "ZIEL": """CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 5 <= 1 THEN concat('OV', event_id % 12)
               WHEN event_id % 5 <= 3 THEN 'IN_SZR_OV' ELSE 'SZR_OV' END""",
    "LHMNR": """CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 13 = 0 THEN concat('LHM-', event_id % 6)
                WHEN event_id % 11 = 0 THEN concat('50', event_id % 6)
                WHEN event_id % 9 = 0 THEN concat('000', event_id % 6) ELSE concat('4', event_id % 6) END""",
    "ARTNR": """CASE WHEN event_id % 31 = 0 THEN '' WHEN event_id % 3 = 0 THEN concat('9', event_id % 1000)
                ELSE concat('2', event_id % 1000) END""",
    "CREATED": "ts",
    "CREATEDBY": "concat('U', user_id)",
}
# The event's own property k gives the codes of the document, which is now and then malformed,
# nested or missing, has text or another document behind it, or a key twice.
_LEDGER_DOCUMENT = """
    CASE WHEN event_id % 47 = 0 THEN NULL WHEN event_id % 41 = 0 THEN 'no document' ELSE concat(
        '{"REFERENCENUMBER_LHM":"', IF(event_id % 37 = 0, concat('REF_', event_id % 10), concat('REF', event_id % 40)),
        '",', IF(event_id % 4 != 0, concat('"LASTEANGOTFROMMAUS_ZIEL":"', 2000000 + event_id % 5000, '",'), ''),
        '"SOURCEID_SEKTOR":', CASE WHEN event_id % 23 = 0 THEN '{"id":1}' WHEN k % 4 = 0 THEN '"1"'
                                   WHEN k % 4 = 1 THEN '"10"' WHEN k % 4 = 2 THEN '"11"' ELSE 'null' END,
        ',"QUALITYID_SEKTOR":', k % 6,
        ',"CATEGORYID_ART":"', k % 7,
        '","DISTRIBUTIONCHANNELID_ART":"', IF(k % 5 = 0, '', CAST(k % 5 AS STRING)),
        '","SKU_ART":"SKU', event_id % 500,
        '","SORTINGCRITERIAID_ART":"', k % 9, IF(event_id % 59 = 0, '","SKU_ART":"again', ''), '"}',
        CASE WHEN event_id % 61 = 0 THEN ' text' WHEN event_id % 67 = 0 THEN '{"SKU_ART":"next"}' ELSE '' END) END"""


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movement ledger from events."""
    events = _table(spark, sf_dir, "events").selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k")
    columns = {**_LEDGER_COLUMNS, "CUST_DATA": _LEDGER_DOCUMENT}
    return as_ledger(events.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()]))
