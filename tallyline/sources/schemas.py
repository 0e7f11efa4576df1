"""Declared schemas. Nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT, _INT, _DAY = T.StringType(), T.IntegerType(), T.DateType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


LEDGER = _schema(
    LOCAL_TRANSACTION_ID=_TEXT,
    SEQUENCE=T.LongType(),
    TPARTNR=_INT,
    TYP_ID=_INT,
    MENGE=_INT,
    LAGBEZ=_TEXT,
    ZIEL=_TEXT,
    LHMNR=_TEXT,
    ARTNR=_TEXT,
    CREATED=T.TimestampNTZType(),
    CREATEDBY=_TEXT,
    CUST_DATA=_TEXT,
)

TRIP_TABLES = {
    "fact_trips": _schema(
        trip_id=_TEXT,
        trip_date=_DAY,
        city_id=_TEXT,
        passenger_type=_TEXT,
        distance_travelled_km=T.DecimalType(18, 2),
        fare_amount=_INT,
        passenger_rating=_INT,
        driver_rating=_INT,
    ),
    "dim_city": _schema(city_id=_TEXT, city_name=_TEXT),
    "dim_date": _schema(date=_DAY, start_of_month=_DAY, month_name=_TEXT, day_type=_TEXT),
    # The bucket label is text: "2-Trips" ... "10-Trips".
    "dim_repeat_trip_distribution": _schema(
        month=_DAY, city_id=_TEXT, trip_count=_TEXT, repeat_passenger_count=_INT
    ),
    "fact_passenger_summary": _schema(
        month=_DAY, city_id=_TEXT, new_passengers=_INT, repeat_passengers=_INT, total_passengers=_INT
    ),
    "monthly_target_trips": _schema(month=_DAY, city_id=_TEXT, total_target_trips=_INT),
    "monthly_target_new_passengers": _schema(month=_DAY, city_id=_TEXT, target_new_passengers=_INT),
    "city_target_passenger_rating": _schema(city_id=_TEXT, target_avg_passenger_rating=T.DecimalType(4, 2)),
}
