"""Aggregation operators. Facts are aggregated before anything is joined to them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyline.functions.ratios import percentage


def per_city(
    facts: DataFrame, cities: DataFrame, by: Sequence[str], *, same: Sequence[str] = (), **sums: str
) -> DataFrame:
    """Roll ``facts``, already aggregated by ``city_id`` and ``by``, up to city *names*.

    The dimension meets aggregates and not the fact rows, so the join is small whatever the fact
    table's size or skew, and needs no broadcast hint. Ids without a city drop out; ids of one name
    merge. ``sums`` maps new columns to the columns to add up; columns of ``same`` have one value everywhere.
    """
    return (
        facts.join(cities.select("city_id", "city_name"), "city_id")
        .groupBy("city_name", *by)
        .agg(*[F.sum(source).alias(name) for name, source in sums.items()], *[F.max(name).alias(name) for name in same])
    )


def ratio_of_sums(rows: DataFrame, group: Sequence[str], **totals: str) -> DataFrame:
    """Sums per group, the basis of ``safe_ratio(SUM(a), SUM(b))``."""
    return rows.groupBy(*group).agg(*[F.sum(source).alias(name) for name, source in totals.items()])


def total_of(counts: DataFrame, name: str) -> Column:
    """The sum of counts per group as a value: the rows below are counted once for both."""
    return counts.agg(F.sum(name)).scalar()


def totals_of(sums: DataFrame, *names: str) -> Column:
    """The sums of several columns as one struct value.

    Asked for all columns of an aggregation, it reads the exchange that the rows themselves are read from.
    """
    return sums.agg(F.struct(*[F.sum(name).alias(name) for name in names]).alias("totals")).scalar()


def share_of_total(rows: DataFrame, group: str) -> DataFrame:
    """Row count per group and its percentage of all rows."""
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("percentage", percentage(F.col("rows"), total_of(counts, "rows")))


def bucket_sums(
    rows: DataFrame, group: Sequence[str], bucket: str, value: str, buckets: Mapping[str, str], total: str
) -> DataFrame:
    """Conditional-sum pivot: one column per bucket label (0 where absent) and the sum of all buckets.

    The labels are known, so one pass over the rows suffices; ``total`` includes unlisted buckets.
    """
    return rows.groupBy(*group).agg(
        *[
            F.sum(F.when(F.col(bucket) == label, F.col(value)).otherwise(0)).alias(name)
            for name, label in buckets.items()
        ],
        F.sum(value).alias(total),
    )


def with_group_total(rows: DataFrame, group: Sequence[str], **totals: str) -> DataFrame:
    """Second level of a two-level aggregation, next to the first: no join of a frame with its roll-up."""
    window = Window.partitionBy(*group)
    return rows.withColumns({name: F.sum(source).over(window) for name, source in totals.items()})
