"""Mixing sources to target weights by histograms over hashes: no sort, no Python.

Every row has a 60-bit hash. A source takes its rows in the order of that hash until its budget is
spent, so the mix is a threshold per source. The threshold is found from histograms: words by source
and leading hash bits, then only the rows of the boundary bucket by the next bits, and so on.

Defined results: a NULL text or one without words has size 0; NULL is a source of its own, the last;
rows of one hash (repeated rows) share what is left evenly, each rounded down; sources without words
have target 0; empty input gives no rows. Further columns are ignored by :func:`mix` and kept by
:func:`apply_mix`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyline.llm.tables import written

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 60
# Bits that one histogram resolves: at most 4,096 lines per source.
LEVEL_BITS = 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of id and text: the same on every run, and another one for another text."""
    row = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(row), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, max_epochs: int) -> DataFrame:
    """``source, source_size`` -> with ``target``, ``epochs`` (whole passes) and ``budget`` (words beyond them).

    Sources share ``share`` of all words by weight; a target ends at ``max_epochs`` times its source
    and the excess goes to the others by weight. In the order of (limit / weight) the sources that
    reach their limit come first, so running sums give the level at which the rest is served. This
    window sees one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    rows = (
        sizes.withColumn("weight", F.get(F.array(*[F.lit(w).cast("long") for w in weights]), place))
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
    )
    everything = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    rows = rows.withColumn("own_level", left.cast("double") / F.sum("weight").over(onward))
    below = F.when(F.col("cap") > F.col("weight") * F.col("own_level"), F.col("own_level"))
    rows = rows.withColumn("level", F.max(below).over(everything))
    target = F.coalesce(F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")), F.col("cap").cast("double"))
    rows = rows.withColumn("target", target)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1)
    return rows.withColumn("epochs", whole.cast("long")).select(
        "source",
        "source_size",
        "target",
        "epochs",
        (F.floor("target").cast("long") - F.col("epochs") * F.col("source_size")).alias("budget"),
    )


def _sized(documents: DataFrame) -> DataFrame:
    return documents.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        row_hash(F.col("doc_id"), F.col("text")).alias("hash"),
    )


def _bits(level: int) -> int:
    return HASH_BITS - LEVEL_BITS * level


def thresholds(sized: DataFrame, weights: Sequence[int], share: float, max_epochs: int) -> DataFrame:
    """One row per source with its target and the boundary: ``edge`` (hash), ``before`` (words below it)
    and ``edge_size`` (words of the rows on it).

    Each level is written, so Spark knows that it is small when it plans the next join.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sizes, weights, share, max_epochs), "mix-targets")
    edges = targets.select("source", "budget", F.lit(0).cast("long").alias("edge"), F.lit(0).cast("long").alias("before"))
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        known = edges.select(F.col("source").alias("_source"), "budget", "edge", "before")
        inside = F.col("source").eqNullSafe(F.col("_source")) & (F.shiftright("hash", _bits(level - 1)) == F.col("edge"))
        cells = (
            sized.join(known, inside)
            .groupBy("source", "budget", "before", F.shiftright("hash", _bits(level)).alias("cell"))
            .agg(F.sum("size").alias("words"))
        )
        below = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        edges = (
            cells.withColumn("low", F.col("before") + F.coalesce(F.sum("words").over(below), F.lit(0)))
            .filter("low <= budget AND budget < low + words")
            .select("source", "budget", F.col("cell").alias("edge"), F.col("low").alias("before"), F.col("words").alias("edge_size"))
        )
        edges = written(edges, f"mix-level-{level}")
    edges = edges.select(F.col("source").alias("_source"), "edge", "before", "edge_size")
    same = F.col("source").eqNullSafe(F.col("_source"))
    return written(targets.join(edges, same, "left").drop("_source"), "mix-thresholds")


def _taken(size: Column, row: Column) -> tuple[Column, Column]:
    """Words taken of a row, and how often the whole row is taken (the boundary row by the nearer number)."""
    left = F.col("budget") - F.col("before")
    part = F.expr("CAST(CAST(size AS DECIMAL(19,0)) * CAST(budget - before AS DECIMAL(19,0)) div edge_size AS BIGINT)")
    extra = F.when(row < F.col("edge"), size).when(row == F.col("edge"), part).otherwise(F.lit(0).cast("long"))
    once_more = (row < F.col("edge")) | ((row == F.col("edge")) & (2 * left >= F.col("edge_size")))
    return (
        F.col("epochs") * size + extra,
        F.col("epochs") + F.coalesce(once_more, F.lit(False)).cast("long"),
    )


def _joined(rows: DataFrame, edges: DataFrame) -> DataFrame:
    known = edges.withColumnRenamed("source", "_source")
    rows = rows.join(known, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    taken, copies = _taken(F.col("size"), F.col("hash"))
    return rows.withColumn("taken", taken).withColumn("copies", copies)


def mix(documents: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """What the mix takes of each document: ``doc_id, source, size, source_size, target, taken, copies``.

    Needs ``doc_id, source, text``. ``taken`` counts words, with repeats; of the one document on a
    source's boundary it counts a part, so that a source's sum is its target rounded down. ``copies``
    takes whole documents only.
    """
    sized = written(_sized(documents), "mix-sizes")
    edges = thresholds(sized, weights, share, max_epochs)
    return _joined(sized, edges).select("doc_id", "source", "size", "source_size", "target", "taken", "copies")


def apply_mix(documents: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """``documents`` as the mix has them: a row for each copy taken, all columns kept.

    The texts are read twice and never shuffled.
    """
    columns = documents.columns
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row")
    edges = thresholds(written(_sized(documents), "mix-sizes"), weights, share, max_epochs)
    sized = documents.select(
        "source", row, word_count(F.col("text")).alias("size"), row_hash(F.col("doc_id"), F.col("text")).alias("hash")
    )
    kept = _joined(sized, edges).filter("copies > 0")
    repeated = kept.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_copy"))
    return repeated.select(*[F.col("_row").getField(c).alias(c) for c in columns])


def oracle(weights: Sequence[int] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2) -> str:
    """The same in DuckDB's SQL, by running sums over the sorted rows."""
    weight = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    return f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS hash
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, source_size * {max_epochs} AS cap,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} {weight} END AS weight FROM sizes),
levels AS (
  SELECT *, (({share}::DOUBLE * (sum(source_size) OVER ())::DOUBLE)
     - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS own_level
  FROM weighted),
targets AS (
  SELECT source, source_size, coalesce(least(cap::DOUBLE, weight * max(CASE WHEN cap > weight * own_level THEN own_level END) OVER ()), cap::DOUBLE) AS target
  FROM levels),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 1 END AS epochs,
    floor(target)::BIGINT - CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 1 END * source_size AS budget
  FROM targets),
cells AS (SELECT source, hash, sum(size)::BIGINT AS words FROM sized GROUP BY source, hash),
placed AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY hash ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low FROM cells)
SELECT s.doc_id, s.source, s.size, b.source_size, b.target,
  (b.epochs * s.size + CASE WHEN p.low + p.words <= b.budget THEN s.size
     WHEN p.low <= b.budget AND p.words > 0 THEN (s.size::HUGEINT * (b.budget - p.low)::HUGEINT) // p.words::HUGEINT
     ELSE 0 END)::BIGINT AS taken,
  (b.epochs + CASE WHEN b.source_size = 0 THEN 0 WHEN p.low + p.words <= b.budget THEN 1
     WHEN p.low <= b.budget AND p.words > 0 AND 2 * (b.budget - p.low) >= p.words THEN 1 ELSE 0 END)::BIGINT AS copies
FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
JOIN placed p ON s.source IS NOT DISTINCT FROM p.source AND s.hash = p.hash"""
