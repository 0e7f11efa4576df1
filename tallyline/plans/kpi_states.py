"""KPI reports from kept sums per city and month, to which new trips are added.

The sums are a table partitioned by month. New trips are summed up, added to the sums of the months they fall in, and only these
partitions are written again; the reports read the sums and no trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyline.functions.calendar import month_start
from tallyline.plans import kpi_reports as reports
from tallyline.session import scratch_path

_SUMS = ("trips", "repeats", "fare", "fares", "km")
STATE = T.StructType(
    [
        T.StructField("city_id", T.StringType()),
        *[T.StructField(name, T.DecimalType(38, 2) if name == "km" else T.LongType()) for name in _SUMS],
        T.StructField("month", T.DateType()),
    ]
)


def trip_sums(trips: DataFrame) -> DataFrame:
    """One row for each city and month of the trips: number, repeated ones, fares and kilometres."""
    repeated = F.when(F.col("passenger_type") == "repeated", 1).otherwise(0)
    sums = trips.groupBy("city_id", month_start(F.col("trip_date")).alias("month")).agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum(repeated).alias("repeats"),
        F.sum("fare_amount").alias("fare"),
        F.count("fare_amount").alias("fares"),
        F.sum("distance_travelled_km").alias("km"),
    )
    return sums.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in STATE])


def read_sums(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE).parquet(path)


def create_sums(trips: DataFrame, path: str) -> None:
    """The sums of the first trips, at a path of their own."""
    trip_sums(trips).repartition("month").write.partitionBy("month").parquet(path)


def add_trips(trips: DataFrame, path: str) -> None:
    """Adds trips that the sums do not hold yet, also late ones of earlier months.

    What is written is one row for each city and month, whatever the number of trips. The new sums are complete in the
    shared folder before a partition is replaced; a batch that was added must not be added again.
    """
    spark = trips.sparkSession
    fresh_path, merged_path = scratch_path(spark, "new-sums"), scratch_path(spark, "merged-sums")
    trip_sums(trips).write.parquet(fresh_path)
    fresh = spark.read.schema(STATE).parquet(fresh_path)
    # A list of months, as a literal condition: the other partitions are not read.
    months = [row.month for row in fresh.select("month").distinct().collect()]
    touched = F.col("month").isin([month for month in months if month is not None])
    if None in months:
        touched = touched | F.col("month").isNull()
    both = read_sums(spark, path).filter(touched).unionByName(fresh)
    merged = both.groupBy("city_id", "month").agg(*[F.sum(name).alias(name) for name in _SUMS])
    merged.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in STATE]).write.parquet(merged_path)
    spark.read.schema(STATE).parquet(merged_path).repartition("month").write.partitionBy("month").mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)


def city_fare_summary(sums: DataFrame, cities: DataFrame) -> DataFrame:
    per_id = sums.groupBy("city_id").agg(*[F.sum(name).alias(name) for name in ("trips", "fare", "fares", "km")])
    return reports.fare_summary_of(per_id, cities)


def target_variance(sums: DataFrame, cities: DataFrame, targets: DataFrame) -> DataFrame:
    return reports.variance_of(sums.select("city_id", "month", "trips"), cities, targets)


def peak_month_share(sums: DataFrame, cities: DataFrame) -> DataFrame:
    return reports.peak_month_share_of(sums.select("city_id", "month", "fare"), cities)


def repeat_rate(sums: DataFrame, cities: DataFrame) -> DataFrame:
    return reports.repeat_rate_of(sums.select("city_id", "month", "trips", "repeats"), cities)
