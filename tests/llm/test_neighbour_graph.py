from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import neighbour_graph, queries
from tallyline.llm.neighbour_graph import nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


def _frame(spark, vectors, extra=()):
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    return spark.createDataFrame([*rows, *extra], SCHEMA)


def _exact(vectors, query, count=5):
    vectors = np.asarray(vectors, np.float32).astype(np.float64)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    sim = unit @ unit[query]
    order = [i for i in np.lexsort((np.arange(len(sim)), -np.round(sim, 12))) if i != query]
    return order[:count], sim


def test_few_vectors_are_exact(spark):
    vectors = np.random.default_rng(1).standard_normal((200, 16))
    got = nearest(_frame(spark, vectors), F.col("vec_id") % 50 == 0).collect()
    assert len(got) == 20
    for query in range(0, 200, 50):
        rows = sorted((r for r in got if r.query_id == query), key=lambda r: r.rank)
        order, sim = _exact(vectors, query)
        assert [r.vec_id for r in rows] == order and [r.rank for r in rows] == [1, 2, 3, 4, 5]
        assert np.allclose([r.score for r in rows], sim[order], atol=1e-12)


def test_recall_against_brute_force(spark, monkeypatch):
    """With blocks so small that the graph has to be found by meeting neighbours of neighbours."""
    monkeypatch.setattr(neighbour_graph, "BLOCK_ROWS", 128)
    monkeypatch.setattr(neighbour_graph, "TABLES", 3)
    rng = np.random.default_rng(2)
    vectors = np.concatenate([rng.standard_normal((3000, 24)), rng.standard_normal(24) + 0.02 * rng.standard_normal((1000, 24))])
    got = nearest(_frame(spark, vectors), F.col("vec_id") % 50 == 0).collect()
    hits = 0
    for query in range(0, len(vectors), 50):
        order, _ = _exact(vectors, query)
        hits += len(set(order) & {r.vec_id for r in got if r.query_id == query})
    assert hits >= 0.9 * 5 * len(range(0, len(vectors), 50))


def test_equal_vectors_and_ties(spark):
    """A third of all vectors are equal: the smaller ids win, and the query isn't its own neighbour."""
    rng = np.random.default_rng(3)
    vectors = np.concatenate([np.tile([1.0, 2.0, 3.0], (60, 1)), rng.standard_normal((120, 3))])
    got = nearest(_frame(spark, vectors), F.col("vec_id") == 0).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == [1, 2, 3, 4, 5]
    got = nearest(_frame(spark, vectors), F.col("vec_id") == 50).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == [0, 1, 2, 3, 4]


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(100, None, 0), (150, [0.0, 0.0], 0), (200, [1.0, None], 0), (250, [nan, 1.0], 0), (300, [inf, 1.0], 0), (350, [1.0], 0), (None, [1.0, 1.0], 0), (50, [1.0, 1.0], 0), (50, [1.0, 1.0], 0)]
    rows = _frame(spark, [[1.0, 0.0], [0.0, 1.0], [1.0, 0.5]], odd).withColumn("node", F.lit("clutter"))
    got = nearest(rows, F.col("vec_id") % 50 == 0).collect()
    assert {r.query_id for r in got} == {0, 50} and {r.vec_id for r in got} == {0, 1, 2, 50}
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == 0] == [2, 50, 1]


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0], 0)]])
def test_nothing_to_find(spark, rows):
    assert nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0).count() == 0


def test_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op8_neighbours(spark, sf).collect()
    table = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids = np.array([r.vec_id for r in table])
    vectors = np.array([r.embedding for r in table])
    hits = total = 0
    for query in np.flatnonzero(ids % 50 == 0):
        order, _ = _exact(vectors, query)
        hits += len(set(ids[order].tolist()) & {r.vec_id for r in got if r.query_id == ids[query]})
        total += len(order)
    assert hits >= 0.95 * total
