"""The six KPI reports on the cab-trip star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyline.functions.calendar import month_label, month_label_padded, month_start
from tallyline.functions.codes import target_status
from tallyline.functions.ratios import percentage, safe_ratio
from tallyline.operators.aggregates import bucket_sums, per_city, totals_of, with_group_total
from tallyline.operators.ranking import best_per_group, fixed_bands, global_rank, nulls_last, top_bottom

# Output column -> bucket label.
TRIP_BUCKETS = {f"trips_{n}": f"{n}-Trips" for n in range(2, 11)}


def city_fare_summary(trips: DataFrame, cities: DataFrame) -> DataFrame:
    """Trips, fare per km, fare per trip and share of all trips, trips of unknown cities included."""
    return fare_summary_of(
        trips.groupBy("city_id").agg(
            F.count(F.lit(1)).alias("trips"),
            F.sum("fare_amount").alias("fare"),
            F.count("fare_amount").alias("fares"),
            F.sum("distance_travelled_km").alias("km"),
        ),
        cities,
    )


def fare_summary_of(per_id: DataFrame, cities: DataFrame) -> DataFrame:
    """The fare summary from ``city_id, trips, fare, fares, km``, one row for each city id."""
    # The total of all, unknown cities too, from the same counts.
    every = totals_of(per_id, "trips", "fare", "fares", "km")
    summary = per_city(per_id, cities, [], total_trips="trips", fare="fare", fares="fares", km="km").withColumn("all_trips", every["trips"])
    return summary.select(
        "city_name",
        "total_trips",
        safe_ratio(F.col("fare"), F.col("km")).alias("avg_fare_per_km"),
        safe_ratio(F.col("fare"), F.col("fares"), scale=0).alias("avg_fare_per_trip"),
        percentage(F.col("total_trips"), F.col("all_trips")).alias("percentage_contribution_to_total_trips"),
    ).orderBy(F.desc("total_trips"), *nulls_last("city_name"))


def target_variance(trips: DataFrame, cities: DataFrame, targets: DataFrame) -> DataFrame:
    """Actual against target trips per city and month; months without either side are left out."""
    per_id = trips.groupBy("city_id", month_start(F.col("trip_date")).alias("month")).agg(
        F.count(F.lit(1)).alias("trips")
    )
    return variance_of(per_id, cities, targets)


def variance_of(per_id: DataFrame, cities: DataFrame, targets: DataFrame) -> DataFrame:
    """The target variance from ``city_id, month, trips``."""
    actual = (
        per_id.join(cities.select("city_id", "city_name"), "city_id")
        .groupBy("city_id", "city_name", "month")
        .agg(F.sum("trips").alias("trips"))
    )
    compared = (
        actual.join(targets.select("city_id", "month", "total_target_trips"), ["city_id", "month"])
        .groupBy("city_name", "month")
        .agg(F.sum("trips").alias("actual_trips"), F.sum("total_target_trips").alias("target_trips"))
    )
    made, wanted = F.col("actual_trips"), F.col("target_trips")
    return compared.orderBy(*nulls_last("city_name", "month")).select(
        "city_name",
        month_label_padded(F.col("month")).alias("month_name"),
        "actual_trips",
        "target_trips",
        target_status(made, wanted).alias("performance_status"),
        percentage(made - wanted, wanted).alias("percentage_difference"),
    )


def repeat_distribution(distribution: DataFrame, cities: DataFrame) -> DataFrame:
    """Percentage of a city's repeat passengers in each trip-count bucket, 2 to 10."""
    per_id = bucket_sums(
        distribution, ["city_id"], "trip_count", "repeat_passenger_count", TRIP_BUCKETS, "all_buckets"
    )
    # A city id that the dimension lists twice adds its buckets twice, but its total once.
    named = (
        per_id.join(cities.select("city_id", "city_name"), "city_id")
        .groupBy("city_name", "city_id")
        .agg(*[F.sum(name).alias(name) for name in TRIP_BUCKETS], F.max("all_buckets").alias("all_buckets"))
        .groupBy("city_name")
        .agg(*[F.sum(name).alias(name) for name in [*TRIP_BUCKETS, "all_buckets"]])
    )
    return named.select(
        "city_name", *[percentage(F.col(name), F.col("all_buckets")).alias(name) for name in TRIP_BUCKETS]
    )


def new_passenger_totals(summary: DataFrame, cities: DataFrame) -> DataFrame:
    per_id = summary.groupBy("city_id").agg(F.sum("new_passengers").alias("new_passengers"))
    return per_city(per_id, cities, [], total_new_passengers="new_passengers")


def top_bottom_cities(summary: DataFrame, cities: DataFrame, k: int = 3) -> DataFrame:
    """The k cities with most and the k with fewest new passengers, for any number of cities."""
    bands = top_bottom(new_passenger_totals(summary, cities), "total_new_passengers", k)
    return bands.withColumnRenamed("category", "city_category")


def top_bottom_cities_fixed(summary: DataFrame, cities: DataFrame) -> DataFrame:
    """The same report with the bands as they are written for ten cities: ranks 1-3 and 8-10."""
    bands = fixed_bands(new_passenger_totals(summary, cities), "total_new_passengers")
    return bands.withColumnRenamed("category", "city_category")


def ranked_cities(summary: DataFrame, cities: DataFrame) -> DataFrame:
    """All cities with their rank from the top and from the bottom by new passengers, ties sharing a rank."""
    totals = new_passenger_totals(summary, cities)
    down = global_rank(totals, "total_new_passengers", name="rank_from_top")
    return global_rank(down, "total_new_passengers", descending=False, name="rank_from_bottom")


def ranked_days(trips: DataFrame) -> DataFrame:
    """Every day's number of trips and its rank, and the rank of its best fare (NULL counts as the greatest)."""
    days = trips.groupBy("trip_date").agg(F.count(F.lit(1)).alias("trips"), F.max("fare_amount").alias("best_fare"))
    return global_rank(global_rank(days, "trips", name="trips_rank"), "best_fare", name="fare_rank")


def _monthly_revenue(trips: DataFrame, cities: DataFrame) -> DataFrame:
    per_id = trips.groupBy("city_id", month_start(F.col("trip_date")).alias("month")).agg(
        F.sum("fare_amount").alias("fare")
    )
    return _best_months(per_id, cities)


def _best_months(per_id: DataFrame, cities: DataFrame) -> DataFrame:
    monthly = per_city(per_id, cities, ["month"], revenue="fare")
    return best_per_group(with_group_total(monthly, ["city_name"], city_revenue="revenue"), ["city_name"], "revenue")


def peak_month_share(trips: DataFrame, cities: DataFrame) -> DataFrame:
    """Best month per city (ties give several rows) and its percentage of the city's revenue."""
    return _peak_shares(_monthly_revenue(trips, cities))


def peak_month_share_of(per_id: DataFrame, cities: DataFrame) -> DataFrame:
    """The same from ``city_id, month, fare``."""
    return _peak_shares(_best_months(per_id, cities))


def _peak_shares(best: DataFrame) -> DataFrame:
    return best.orderBy(*nulls_last("city_name", "month")).select(
        "city_name",
        month_label(F.col("month")).alias("highest_revenue_month"),
        "revenue",
        percentage(F.col("revenue"), F.col("city_revenue")).alias("percentage_contribution"),
    )


def peak_month_share_int(trips: DataFrame, cities: DataFrame) -> DataFrame:
    """The share with integer division, as two bigint sums divide in PostgreSQL: 0, or 100 for a single month."""
    share = F.call_function("div", F.col("revenue"), F.nullif(F.col("city_revenue"), F.lit(0))) * 100
    return (
        _monthly_revenue(trips, cities)
        .orderBy(*nulls_last("city_name", "month"))
        .select(
            "city_name",
            month_label(F.col("month")).alias("highest_revenue_month"),
            "revenue",
            share.alias("percentage_contribution"),
        )
    )


def repeat_rate(trips: DataFrame, cities: DataFrame) -> DataFrame:
    """Repeat rate per city and month, and per city. ``total_passengers`` counts trips, not persons."""
    repeated = F.when(F.col("passenger_type") == "repeated", 1).otherwise(0)
    per_id = trips.groupBy("city_id", month_start(F.col("trip_date")).alias("month")).agg(
        F.count(F.lit(1)).alias("trips"), F.sum(repeated).alias("repeats")
    )
    return repeat_rate_of(per_id, cities)


def repeat_rate_of(per_id: DataFrame, cities: DataFrame) -> DataFrame:
    """The repeat rates from ``city_id, month, trips, repeats``."""
    monthly = per_city(per_id, cities, ["month"], total_passengers="trips", repeat_passengers="repeats")
    both = with_group_total(
        monthly, ["city_name"], city_passengers="total_passengers", city_repeats="repeat_passengers"
    )
    return both.orderBy(*nulls_last("city_name", "month")).select(
        "city_name",
        month_label_padded(F.col("month")).alias("month"),
        "total_passengers",
        "repeat_passengers",
        percentage(F.col("repeat_passengers"), F.col("total_passengers")).alias("monthly_repeat_passenger_rate"),
        percentage(F.col("city_repeats"), F.col("city_passengers")).alias("city_repeat_passenger_rate"),
    )
