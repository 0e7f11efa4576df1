from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import queries, toxicity

INSULTS = "idiot moron scum clown".split()


def _corpus(spark, rows=900):
    """Toxic sentences name a group more often than clean ones do; the groups themselves are neutral."""
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    docs, labels = [], []
    for i in range(rows):
        toxic = int(rng.random() < 0.3)
        text = [rng.choice(words) for _ in range(30)]
        if toxic:
            text.insert(rng.randrange(30), rng.choice(INSULTS))
        if rng.random() < (0.5 if toxic else 0.05):
            text.insert(rng.randrange(30), "muslims")
        docs.append((i, " ".join(text)))
        labels.append((i, 1, toxic))
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels = _corpus(spark)
    return docs, labels, toxicity.train(docs, labels)


def test_held_out_accuracy(trained):
    docs, labels, model = trained
    rows = toxicity.score(docs, model).join(labels, "doc_id").withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    held = [r for r in rows if r.held]
    assert len(held) > 200
    assert np.mean([(r.score >= 0.7) == (r.toxic == 1) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_swaps_do_not_change_scores(trained, spark, monkeypatch):
    docs, labels, model = trained
    monkeypatch.setattr(toxicity, "SWAP_WEIGHT", 0.0)
    plain = toxicity.train(docs, labels)

    def gap(m):
        score = m.scorer()
        logit = lambda t: float(np.log(score(t) / (1 - score(t))))
        return abs(logit("the muslims came") - logit("the believers came"))

    assert gap(plain) > 0.3
    assert gap(model) < 0.3 * gap(plain)


def test_swapped_sentences_are_built():
    """A swap loses what no other word of the sentence has, at every level, and gains the same for the other term."""
    sentence = {"the", "muslims", "muslin", "came"}
    found = list(toxicity.swapped_features(sentence))
    group = next(g for g in toxicity.IDENTITY_LISTS if "muslims" in g)
    assert len(found) == len(group) - 1 and sum(weight for *_, weight in found) == pytest.approx(1)
    whole = set(toxicity.text_features(sentence))
    for (gone, come, _), other in zip(found, [t for t in group if t != "muslims"]):
        swapped = set(toxicity.text_features({"the", other, "muslin", "came"}))
        assert set(gone) == whole - swapped and set(come) == swapped - whole
    lost = {(f >> 24, f & 0xFFFFFF) for f in found[0][0]}
    same = set(toxicity.word_features("muslin"))
    own = set(toxicity.word_features("muslims"))
    # Beginnings that both words have fall from the second level to the first; the others go.
    assert lost == {(1, f) for f in own & same} | {(0, f) for f in own - same}
    assert not list(toxicity.swapped_features({"nobody", "came"}))


def test_weights_of_shared_beginnings_count(spark, monkeypatch):
    """Toxic sentences name a group beside a word that begins alike: only a feature of the second level tells them."""
    rng = random.Random(2)
    words = ["".join(rng.choice("bcdfg") for _ in range(5)) for _ in range(150)]
    docs, labels = [], []
    for i in range(900):
        toxic, text = int(rng.random() < 0.4), [rng.choice(words) for _ in range(20)]
        text += ["muslims", "muslin"] if toxic else rng.choice([["muslims"], ["muslin"], ["believers", "muslin"]])
        docs.append((i, " ".join(text)))
        labels.append((i, 1, toxic))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")

    def gap(model):
        score = model.scorer()
        logit = lambda t: float(np.log(score(t) / (1 - score(t))))
        return abs(logit("the muslims sold muslin") - logit("the believers sold muslin"))

    regularised = gap(toxicity.train(docs, labels))
    monkeypatch.setattr(toxicity, "SWAP_WEIGHT", 0.0)
    assert regularised < 0.5 * gap(toxicity.train(docs, labels))


def test_labels_of_held_out_rows_are_not_read(trained, spark):
    docs, labels, model = trained
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, flipped) == model


def test_odd_documents(trained, cluttered, odd_rows):
    _, _, model = trained
    got = toxicity.score(cluttered, model)
    assert got.count() == len(odd_rows)
    scores = {r.doc_id: r.score for r in got.collect()}
    assert scores[1] == scores[3] == scores[2] == pytest.approx(1 / (1 + np.exp(-model.bias)))


def test_degenerate_labels(spark, odd, cluttered, odd_rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert max(r.score for r in toxicity.score(odd, toxicity.train(odd, none)).collect()) < 1e-9
    toxic = spark.createDataFrame([(i, 1, 1) for i in range(16)] + [(None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    assert min(r.score for r in toxicity.score(odd, toxicity.train(odd, toxic)).collect()) > 0.99
    kept = toxicity.drop_toxic(cluttered, none)
    assert kept.dtypes == cluttered.dtypes and kept.count() == len(odd_rows)


def test_empty(empty, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.drop_toxic(empty, none).count() == 0


def test_query_catches_held_out_toxic_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op6_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    stats = got.agg(
        (F.sum(F.col("predicted") * F.col("toxic")) / F.sum("toxic")).alias("recall"),
        F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("false"),
    ).first()
    assert stats.recall > 0.8 and stats.false < 0.01
