"""Approximate nearest neighbours: an NN-descent graph, searched greedily.

Equal vectors are one node with its members. Nodes start with the best of a few blocks of at most
``BLOCK_ROWS`` nodes (cells of random hyperplanes, divided by hash where they are large) and then
meet the neighbours of their neighbours, round after round: each node compares its neighbours, those that
point to it included, and every pair that beats the worst neighbour of one of the two becomes an edge. Only pairs with
a fresh edge are compared again. A query starts at its own node and always goes on from the best nodes
it has not gone on from yet.

All steps are joins by node; a task sees the few neighbours of a node, never a cell of unknown size.
What a node keeps per round is bounded (``DEGREE`` best, as many pointing back); the bound costs recall,
which tests measure against brute force, and not the whole index: every vector is in the graph.

Defined results: vectors that are NULL, zero, of another length than most, or with NULL or non-finite
components take no part; NULL ids neither; repeated rows are members of one node, with their ids counted once; ties go to the
smaller id; fewer candidates than asked for give fewer rows; empty input gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyline.llm.tables import written

DEGREE = 32
SAMPLE = 14
ROUNDS = 8
# Share of fresh edges below which the graph counts as settled.
SETTLED = 0.01
BLOCK_ROWS = 2048
TABLES = 10
PLANES = 10
EXPANDED = 24
BEAM = 192
STEPS = 8
SEED = 11


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, vec`` -> ``node, half``: unit vectors in half precision, for building only."""
    for batch in batches:
        vectors = _matrix(batch.column(1))
        unit = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float16)
        halves = pa.array([row.tobytes() for row in unit], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), halves], ["node", "half"])


def _half_matrix(column: pa.Array) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), np.float16)
    return flat.reshape(len(column), -1).astype(np.float32)


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, vec`` (doubles) of the vectors that take part."""
    vec = F.col("embedding").cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select("vec_id", vec.alias("vec")).filter(
        F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("vec", lambda x: x != 0), F.lit(False))
    )
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("vec") == (sizes[0]["n"] if sizes else 0))


def _best(rows: DataFrame, keys: list[str], order: list[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows per key; Spark cuts each task's rows before it shuffles."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).filter(F.col("_place") <= limit).drop("_place")


# --- the graph ----------------------------------------------------------------------------------------


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, pa.RecordBatch]]:
    """Runs of rows with one key in the first column, of batches sorted by it."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
        if not table.num_rows:
            continue
        batch = table.to_batches()[0]
        key = batch.column(0).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            yield key[a], batch.slice(a, b - a)
        rest = batch.slice(int(starts[-1]))
    if rest is not None:
        yield rest.column(0)[0].as_py(), rest


def _edges(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    src, dst, sim = (np.concatenate([p[i] for p in parts]) for i in range(3))
    return pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst), pa.array(sim.astype(np.float64))], ["src", "dst", "sim"])


def _block_neighbours(batches: Iterator[pa.RecordBatch], degree: int) -> Iterator[pa.RecordBatch]:
    """Each node's best in its block: ``block, node, half`` sorted by block."""
    parts, rows = [], 0
    for _, group in _sorted_groups(batches):
        node = group.column(1).to_numpy()
        if len(node) < 2:
            continue
        unit = _half_matrix(group.column(2))
        k = min(degree, len(node) - 1)
        for a in range(0, len(node), 256):
            sim = unit[a : a + 256] @ unit.T
            sim[np.arange(len(sim)), np.arange(a, a + len(sim))] = -2
            best = np.argpartition(-sim, k - 1, axis=1)[:, :k]
            parts.append((np.repeat(node[a : a + 256], k), node[best].ravel(), np.take_along_axis(sim, best, 1).ravel()))
            rows += len(sim) * k
        if rows > 100_000:
            yield _edges(parts)
            parts, rows = [], 0
    if parts:
        yield _edges(parts)


def _first_graph(nodes: DataFrame, halves: DataFrame, degree: int, size: int, dimension: int) -> DataFrame:
    """The best neighbours in a few tables of blocks; a large cell is divided by hash."""
    random = np.random.default_rng(SEED)
    planes = int(np.clip(np.ceil(np.log2(max(1, size / BLOCK_ROWS))), 0, PLANES))
    keys = []
    for table in range(TABLES):
        key = F.lit(table)
        for _ in range(planes):
            plane = F.array(*[F.lit(float(x)) for x in random.standard_normal(dimension)])
            dot = F.aggregate(F.zip_with("vec", plane, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
            key = key * 2 + F.when(dot > 0, 1).otherwise(0)
        keys.append(F.struct(F.lit(table).alias("table"), key.alias("cell")))
    placed = written(nodes.select("node", F.explode(F.array(*keys)).alias("c")).select("node", "c.*"), "ann-cells")
    # At most TABLES * 2 ** PLANES lines.
    sizes = placed.groupBy("table", "cell").agg(F.ceil(F.count("node") / BLOCK_ROWS).alias("pieces"))
    piece = F.pmod(F.xxhash64("node", "table"), F.col("pieces"))
    blocks = (
        placed.join(F.broadcast(sizes), ["table", "cell"])
        .select("node", F.xxhash64("table", "cell", piece).alias("block"))
        .join(halves, "node")
        .select("block", "node", "half")
    )
    found = (
        blocks.repartition("block").sortWithinPartitions("block").mapInArrow(
            lambda batches: _block_neighbours(batches, degree), "src long, dst long, sim double"
        )
    )
    return _kept(found.withColumn("fresh", F.lit(True)), degree)


def _kept(edges: DataFrame, degree: int) -> DataFrame:
    """The best neighbours of each node; an edge found again is as fresh as the first one."""
    single = edges.groupBy("src", "dst").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    return _best(single, ["src"], [F.desc("sim"), F.col("dst")], degree)


def _meet(batches: Iterator[pa.RecordBatch], keep: int) -> Iterator[pa.RecordBatch]:
    """Pairs of a node's neighbours that beat the worst neighbour of one of the two.

    Rows are ``node, nbr, fresh, worst, half`` sorted by node. Each neighbour gets its ``keep`` best others.
    """
    parts, rows = [], 0
    for _, group in _sorted_groups(batches):
        fresh = group.column(2).to_numpy(zero_copy_only=False)
        if len(fresh) < 2 or not fresh.any():
            continue
        nbr, worst = group.column(1).to_numpy(), group.column(3).to_numpy()
        unit = _half_matrix(group.column(4))
        sim = unit @ unit.T
        wanted = (fresh[:, None] | fresh[None, :]) & (nbr[:, None] != nbr[None, :]) & (sim > worst[:, None])
        sim = np.where(wanted, sim, -2)
        k = min(keep, len(nbr) - 1)
        best = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        value = np.take_along_axis(sim, best, 1)
        a, b = np.nonzero(value > -2)
        parts.append((nbr[a], nbr[best[a, b]], value[a, b]))
        rows += len(a)
        if rows > 100_000:
            yield _edges(parts)
            parts, rows = [], 0
    if rows:
        yield _edges(parts)


def _both_ways(graph: DataFrame, limit: int, round_number: int) -> DataFrame:
    """Neighbours and nodes pointing back, ``limit`` of each kind, fresh ones first."""
    order = [F.desc("fresh"), F.xxhash64("node", "nbr", F.lit(round_number))]
    ahead = _best(graph.select(F.col("src").alias("node"), F.col("dst").alias("nbr"), "fresh"), ["node"], order, limit)
    back = _best(graph.select(F.col("dst").alias("node"), F.col("src").alias("nbr"), "fresh"), ["node"], order, limit)
    return ahead.unionByName(back).groupBy("node", "nbr").agg(F.max("fresh").alias("fresh"))


def build_graph(nodes: DataFrame, degree: int = DEGREE, rounds: int = ROUNDS, sample: int = SAMPLE) -> DataFrame:
    """``node, vec`` -> ``src, dst, sim``: about the ``degree`` nearest of each node."""
    shape = nodes.agg(F.count("node").alias("n"), F.max(F.size("vec")).alias("d")).first()
    size, dimension = shape["n"], shape["d"] or 0
    halves = written(nodes.select("node", "vec").mapInArrow(_halved, "node long, half binary"), "ann-halves")
    graph = written(_first_graph(nodes, halves, degree, size, dimension), "ann-graph")
    for number in range(rounds):
        worst = graph.groupBy("src").agg(F.min("sim").alias("worst"), F.count("dst").alias("n"))
        bound = F.when(F.col("n") >= degree, F.col("worst")).otherwise(-1.5)
        vectors = written(
            halves.join(worst.withColumnRenamed("src", "node"), "node", "left").select(
                F.col("node").alias("nbr"), F.coalesce(bound, F.lit(-1.5)).alias("worst"), "half"
            ),
            "ann-vectors",
        )
        met = written(_both_ways(graph, 2 * sample, number), "ann-met")
        active = met.filter("fresh").select("node").distinct()
        sides = met.join(active, "node", "left_semi").join(vectors, "nbr").select("node", "nbr", "fresh", "worst", "half")
        found = sides.repartition("node").sortWithinPartitions("node").mapInArrow(
            lambda batches: _meet(batches, sample), "src long, dst long, sim double"
        )
        # Edges whose two ends have met are no longer fresh.
        seen = met.filter("fresh").select(F.col("node").alias("src"), F.col("nbr").alias("dst"), F.lit(True).alias("seen"))
        old = graph.join(seen, ["src", "dst"], "left").select("src", "dst", "sim", (F.col("fresh") & F.col("seen").isNull()).alias("fresh"))
        graph = written(_kept(old.unionByName(found.withColumn("fresh", F.lit(True))), degree), "ann-graph")
        if graph.filter("fresh").count() < SETTLED * size * degree:
            break
    return graph.select("src", "dst", "sim")


# --- search --------------------------------------------------------------------------------------------


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``query, node, a, b`` -> ``query, node, sim`` in double precision."""
    for batch in batches:
        a, b = _matrix(batch.column(2)), _matrix(batch.column(3))
        sim = np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sim)], ["query", "node", "sim"])


def _measured(pairs: DataFrame, starts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The similarity of each ``query, node``; a query is named by its own node."""
    own = starts.select("query", F.col("vec").alias("a"))
    other = nodes.select("node", F.col("vec").alias("b"))
    rows = pairs.join(other, "node").join(own, "query").select("query", "node", "a", "b")
    return rows.mapInArrow(_cosines, "query long, node long, sim double")


def greedy_search(
    graph: DataFrame, nodes: DataFrame, starts: DataFrame, beam: int = BEAM, expanded: int = EXPANDED, steps: int = STEPS
) -> DataFrame:
    """``query, node, sim``: the best nodes that each of ``starts`` (nodes) reaches, itself not among them."""
    starts = starts.select(F.col("node").alias("query"), "vec")
    ways = written(
        graph.select("src", "dst").unionByName(_best(graph, ["dst"], [F.desc("sim"), F.col("src")], DEGREE).select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(),
        "ann-ways",
    )
    state = None
    frontier = starts.select("query", F.col("query").alias("node"))
    for _ in range(steps):
        ahead = frontier.join(ways, frontier["node"] == ways["src"]).select("query", F.col("dst").alias("node")).distinct()
        ahead = ahead.filter("query <> node")
        if state is not None:
            ahead = ahead.join(state.select("query", "node"), ["query", "node"], "left_anti")
        fresh = _measured(ahead, starts, nodes).withColumn("open", F.lit(True))
        every = fresh if state is None else state.unionByName(fresh)
        ranked = every.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("sim"), "node")))
        ranked = ranked.filter(F.col("place") <= beam)
        by_open = Window.partitionBy("query").orderBy(F.desc("open"), "place")
        ranked = ranked.withColumn("turn", F.row_number().over(by_open))
        chosen = F.col("open") & (F.col("turn") <= expanded)
        state = written(ranked.select("query", "node", "sim", (F.col("open") & ~chosen).alias("open"), chosen.alias("chosen")), "ann-beam")
        frontier = state.filter("chosen").select("query", "node")
        state = state.drop("chosen")
        if frontier.isEmpty():
            break
    return state.select("query", "node", "sim")


def nearest(embeddings: DataFrame, is_query: Column, count: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``count`` nearest vectors found for each query row, never itself."""
    rows = written(usable(embeddings), "ann-rows")
    members = rows.groupBy("vec").agg(F.min("vec_id").alias("node"))
    nodes = written(members.select("node", "vec"), "ann-nodes")
    members = written(rows.join(nodes, "vec").select("node", "vec_id").distinct(), "ann-members")
    graph = build_graph(nodes)
    queries = members.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("node").alias("query"))
    starts = nodes.join(queries.select(F.col("query").alias("node")).distinct(), "node")
    starts = written(starts, "ann-starts")
    found = greedy_search(graph, nodes, starts)
    own = _measured(starts.select(F.col("node").alias("query"), "node"), starts.withColumnRenamed("node", "query"), nodes)
    near = _best(found.unionByName(own), ["query"], [F.desc("sim"), F.col("node")], count + 1)
    # One member more than asked for, as the query may be one of them itself.
    first = _best(members, ["node"], [F.col("vec_id")], count + 1)
    pairs = queries.join(near, "query").join(first, "node").filter("vec_id <> query_id")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("sim"), "vec_id")
    return (
        pairs.withColumn("rank", F.row_number().over(by_score))
        .filter(F.col("rank") <= count)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("sim").alias("score"))
    )
