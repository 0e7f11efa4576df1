from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyline.llm import quality, queries

LABELS = "doc_id long, quality int, toxic int"


def _corpus(spark, rows=900):
    """Bad documents have signs in their words, repeat words, or are all in capitals."""
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    docs, labels = [], []
    for i in range(rows):
        text, good = [rng.choice(words) for _ in range(rng.randint(20, 60))], int(rng.random() < 0.8)
        if not good:
            kind = rng.randrange(3)
            text = [w + "&&&" for w in text] if kind == 0 else [w.upper() for w in text] if kind == 1 else [w for w in text[:9] for _ in range(5)]
        docs.append((i, " ".join(text)))
        labels.append((i, good, 0))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels = _corpus(spark)
    return docs, labels, quality.train(docs, labels)


def test_held_out_accuracy_and_calibration(trained):
    docs, labels, model = trained
    rows = quality.score(docs, model).join(labels, "doc_id").withColumn("held", quality.held_out(F.col("doc_id"))).collect()
    held = [r for r in rows if r.held]
    assert len(held) > 120 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([(r.score >= quality.THRESHOLD) == (r.quality == 1) for r in held]) > 0.95
    # Calibrated: the mean score is the share of good documents.
    assert abs(np.mean([r.score for r in held]) - np.mean([r.quality for r in held])) < 0.05


def test_labels_of_held_out_rows_are_not_read(trained):
    docs, labels, model = trained
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.train(docs, flipped)
    texts = pa.array([r.text for r in docs.limit(50).collect()])
    assert (again.scores(texts) == model.scores(texts)).all()


def _plain_words(text):
    words = re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|[^\x00-\x200-9A-Za-z\x80-\U0010ffff]+", text or "")
    return [None if i and words[i - 1] == w else w for i, w in enumerate(words)]


def test_word_vectors_equal_a_plain_sum(spark):
    """Neighbours' index vectors summed one by one; rows in several tasks, two levels of sums."""
    texts = ["a b&& c a b.", None, "", "été x x x, y", "\x00 q!", "a b&& c a b."] * 5
    bucket_of = {w: int(quality.bucketed(pa.array([w]))[0][0]) for t in texts for w in _plain_words(t) if w}
    places, signs = quality._index_entries()
    index = np.zeros((1 << quality.BUCKET_BITS, quality.DIMENSIONS))
    for k in range(quality.NONZERO):
        index[np.arange(len(index)), places[:, k]] += signs[k]
    expected, counts = np.zeros_like(index), np.zeros(len(index))
    for text in texts:
        buckets = [quality._AGAIN if w is None else bucket_of[w] for w in _plain_words(text)]
        for i, b in enumerate(buckets):
            counts[b] += 1
            for j in range(max(0, i - quality.WINDOW), min(len(buckets), i + quality.WINDOW + 1)):
                if i != j:
                    expected[b] += index[buckets[j]]
    found = quality.word_vectors(spark.createDataFrame([(t,) for t in texts], "text string").repartition(7))
    norms = np.sqrt((expected**2).sum(axis=1))
    assert np.allclose(found.vectors, expected / np.where(norms > 0, norms, 1)[:, None], atol=1e-6)
    assert np.allclose(found.weights, quality.COMMON / (quality.COMMON + counts / counts.sum()), rtol=1e-5)


def test_groups_of_parts(spark, monkeypatch):
    """Sums of many parts in groups equal the sums of all."""
    monkeypatch.setattr(quality, "_GROUP", 2)
    rows = [(part, slice_, np.array([part, slice_, 1], np.int64).tobytes()) for part in range(9) for slice_ in range(3)]
    twice = quality._summed(quality._summed(spark.createDataFrame([(p, s, bytearray(b)) for p, s, b in rows], quality._PART))).collect()
    total = {k: sum(np.frombuffer(bytes(r.sums), np.int64) for r in twice if r.slice == k).tolist() for k in range(3)}
    assert total == {k: [36, 9 * k, 9] for k in range(3)} and len(twice) < 27


def test_pooling_is_the_mean(monkeypatch):
    random_ = np.random.default_rng(1)
    words = quality.WordVectors(
        random_.normal(size=(1 << quality.BUCKET_BITS, quality.DIMENSIONS)).astype(np.float32),
        random_.random(1 << quality.BUCKET_BITS).astype(np.float32),
    )
    texts = pa.array(["a b c d e f g", None, "", "x", "a a b"])
    bucket, owner = quality.bucketed(texts)
    whole = words.pooled(bucket, owner, len(texts))
    monkeypatch.setattr(quality, "_POOLED_WORDS", 2)
    assert np.allclose(words.pooled(bucket, owner, len(texts)), whole, atol=1e-5)
    assert not whole[1:3].any()
    own = bucket[owner == 0]
    assert np.allclose(whole[0, : quality.DIMENSIONS], words.vectors[own].mean(axis=0), atol=1e-5)
    weights = words.weights[own]
    assert np.allclose(whole[0, quality.DIMENSIONS :], (words.vectors[own] * weights[:, None]).sum(axis=0) / weights.sum(), atol=1e-5)


def test_slopes_of_the_network_lower_the_loss():
    random_ = np.random.default_rng(2)
    rows = random_.normal(size=(600, 6))
    good = (rows[:, 0] * rows[:, 1] > 0).astype(float)  # no single layer can tell
    network = quality.fit_network(rows, good)
    assert np.mean((network.scores(rows) > 0.5) == good) > 0.9


def test_temperature_of_overconfident_logits():
    random_ = np.random.default_rng(3)
    true = random_.normal(size=20_000)
    good = (random_.random(20_000) < 1 / (1 + np.exp(-true))).astype(float)
    assert quality.fit_temperature(4 * true, good) == pytest.approx(4, rel=0.15)
    assert quality.fit_temperature(np.zeros(0), np.zeros(0)) == 1.0


def test_odd_documents(trained, cluttered, odd_rows):
    _, _, model = trained
    got = quality.score(cluttered, model).collect()
    assert len(got) == len(odd_rows)
    scores = {r.doc_id: r.score for r in got}
    assert scores[1] == scores[2] == scores[3] and 0 <= scores[1] <= 1


def test_degenerate_labels(spark, odd):
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in quality.score(odd, quality.train(odd, none)).collect()} == {0.5}
    bad = spark.createDataFrame([(i, 0, 0) for i in range(16)] + [(None, 1, 1), (4, None, None), (6, 1, 0)], LABELS)
    assert {r.score for r in quality.score(odd, quality.train(odd, bad)).collect()} == {0.0}
    mixed = spark.createDataFrame([(i, i % 2, 0) for i in range(17)], LABELS)
    assert all(0 <= r.score <= 1 for r in quality.score(odd, quality.train(odd, mixed)).collect())


def test_empty(empty, spark):
    model = quality.train(empty, spark.createDataFrame([], LABELS))
    assert quality.score(empty, model).count() == 0
    assert not quality.word_vectors(empty).vectors.any()


def test_query_tells_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op11_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    stats = got.agg(
        F.avg(F.when(F.col("quality") == 1, F.col("predicted"))).alias("kept"),
        F.avg(F.when(F.col("quality") == 0, F.col("predicted"))).alias("missed"),
    ).first()
    assert stats.kept > 0.95 and stats.missed < 0.2
