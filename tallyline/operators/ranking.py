"""Previews, bands by rank, and the best rows per group. PostgreSQL null order: last ascending, first descending."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyline.operators.numbering import sliced


def table_preview(rows: DataFrame, n: int | None = None, order: Sequence[str] = ()) -> DataFrame:
    """The table, or ``n`` of its rows: any, which reads no more than it needs, or the first by the key ``order``."""
    if n is None:
        return rows
    return (rows.orderBy(*nulls_last(*order)) if order else rows).limit(n)


def top_bottom(totals: DataFrame, metric: str, k: int = 3) -> DataFrame:
    """Groups whose rank from either end is at most ``k``, ties included, labelled ``category``.

    A rank is at most k exactly if the value reaches the k-th value, so two top-k lookups give the
    limits and no global window is needed. A group in both bands counts as top.
    """
    keyed = totals.withColumn("_key", F.struct(F.col(metric).isNull(), F.col(metric)))
    key = F.col("_key")
    ends = keyed.select("_key")
    top = ends.orderBy(key.desc()).limit(k).agg(F.min("_key")).scalar()
    bottom = ends.orderBy(key.asc()).limit(k).agg(F.max("_key")).scalar()
    label = F.when(key >= top, f"Top {k}").when(key <= bottom, f"Bottom {k}")
    return keyed.withColumn("category", label).filter(F.col("category").isNotNull()).drop("_key")


def fixed_bands(totals: DataFrame, metric: str) -> DataFrame:
    """Ranks 1-3 as ``Top 3`` and 8-10 as ``Bottom 3``: the bottom only if there are ten groups and no ties.

    The rank of a value is one more than the number of groups above it, so the ten highest values and
    their counts give all ranks up to ten, and ties never meet in one task.
    """
    highest = F.desc_nulls_first("_value")
    values = totals.groupBy(F.col(metric).alias("_value")).agg(F.count(F.lit(1)).alias("_groups"))
    above = Window.orderBy(highest).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        values.orderBy(highest).limit(10).withColumn("_rank", F.coalesce(F.sum("_groups").over(above), F.lit(0)) + 1)
    )
    band = F.when(F.col("_rank").between(1, 3), "Top 3").when(F.col("_rank").between(8, 10), "Bottom 3")
    bands = ranks.select("_value", band.alias("category")).filter("category IS NOT NULL")
    return totals.join(F.broadcast(bands), F.col(metric).eqNullSafe(F.col("_value"))).drop("_value")


def global_rank(rows: DataFrame, metric: str, *, descending: bool = True, name: str = "rank") -> DataFrame:
    """``rows`` with ``RANK() OVER (ORDER BY metric)``, ties sharing a rank; NULL is the greatest value.

    Any number of rows: the distinct values with their row counts are cut into sampled slices and summed up inside each; what lies in
    earlier slices is a sum over one row per slice, at most ``SLICES``. The ranks are joined to the rows by value, and
    Spark splits a value that many rows share.
    """
    packed = rows.selectExpr(f"struct({', '.join(f'`{c}`' for c in rows.columns)}) AS _row", f"struct(`{metric}` IS NULL AS none, `{metric}` AS value) AS _value")
    counts = sliced(packed.groupBy("_value").agg(F.count(F.lit(1)).alias("_rows")), "_value")
    shared = counts.selectExpr("_slice", "_value", "_rows").repartition("_slice")
    # Counting the values themselves keeps the exchange the same for both readers.
    per_slice = shared.groupBy("_slice").agg(F.expr("sum(IF(_value IS NULL, 0, _rows)) AS _in_slice"))
    offsets = per_slice.selectExpr(
        "_slice",
        "sum(_in_slice) OVER (ORDER BY _slice ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - _in_slice AS _before",
        "sum(_in_slice) OVER () AS _every",
    )
    upto = shared.selectExpr("*", "sum(_rows) OVER (PARTITION BY _slice ORDER BY _value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _upto")
    rank = "_every - _before - _upto + 1" if descending else "_before + _upto - _rows + 1"
    ranks = upto.join(offsets, "_slice").selectExpr("_value", f"{rank} AS `{name}`")
    return packed.join(ranks, "_value").selectExpr(*[f"_row.`{c}` AS `{c}`" for c in rows.columns], f"`{name}`")


def best_per_group(rows: DataFrame, group: Sequence[str], metric: str) -> DataFrame:
    """Rows of rank 1 by ``metric``, ties kept."""
    rank = F.rank().over(Window.partitionBy(*group).orderBy(F.desc_nulls_first(metric)))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def nulls_last(*names: str) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in names]
