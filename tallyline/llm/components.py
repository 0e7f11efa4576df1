"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyline.llm.tables import written


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``a, b`` -> ``node, root``: the least node reachable, for every node of an edge.

    Large-star and small-star steps alternate until the edges no longer change: every step joins each
    node's neighbours to their least one, so the rounds grow with the logarithm of the longest path.
    Least neighbours are aggregated before the shuffle and written, so that the join of a hub with its
    neighbours is one that Spark can split. NULL ends and loops are ignored; no edges give no rows.
    """
    current = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b")
        .distinct(),
        f"{name}-edges",
    )
    state = _state(current)
    while state[0]:
        current = _small_star(_large_star(current, name), name)
        state, before = _state(current), state
        if state == before:
            break
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("a"), F.expr("bit_xor(xxhash64(a, b))")).first())


def _large_star(edges: DataFrame, name: str) -> DataFrame:
    """The larger neighbours of each node go to the least of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.min("b").alias("least")), f"{name}-least")
    return written(
        both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct(),
        f"{name}-large",
    )


def _small_star(edges: DataFrame, name: str) -> DataFrame:
    """Each node and its smaller neighbours go to the least of them."""
    least = written(edges.groupBy("a").agg(F.min("b").alias("least")), f"{name}-least")
    moved = edges.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return written(moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct(), f"{name}-small")
