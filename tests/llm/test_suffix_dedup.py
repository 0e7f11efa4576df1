from __future__ import annotations

import random
from collections import defaultdict

import pyarrow as pa
import pytest

from tallyline.llm import hash_filter, suffix_dedup
from tallyline.llm.arrow_words import words
from tallyline.llm.suffix_dedup import minimisers, repeated_passages

SCHEMA = "doc_id long, text string"
LEAST = suffix_dedup.LEAST_WORDS


def _words(rng, n, letters="abcdefghijklmnop"):
    return ["".join(rng.choice(letters) for _ in range(5)) for _ in range(n)]


def _plain(texts):
    """Words of each document inside a run of 50 that another document has."""
    seen = defaultdict(list)
    for doc, text in texts:
        own = (text or "").split()
        for i in range(len(own) - LEAST + 1):
            seen[tuple(own[i : i + LEAST])].append((doc, i))
    covered = defaultdict(set)
    for places in seen.values():
        if len({doc for doc, _ in places}) > 1:
            for doc, i in places:
                covered[doc].update(range(i, i + LEAST))
    return dict(covered)


def _found(rows):
    covered = defaultdict(set)
    for r in rows:
        assert r.n_words == r.end_word - r.first_word >= LEAST
        assert not covered[r.doc_id] & set(range(r.first_word, r.end_word))
        covered[r.doc_id].update(range(r.first_word, r.end_word))
    return dict(covered)


def _corpus(seed, docs=60):
    rng = random.Random(seed)
    passages = [_words(rng, rng.choice([30, 49, 50, 51, 60, 90, 200])) for _ in range(25)]
    texts = []
    for i in range(docs):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts += _words(rng, rng.randint(0, 60)) + (rng.choice(passages) if rng.random() < 0.7 else [])
        texts.append((i, rng.choice([" ", "\n", "  "]).join(parts)))
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("partitions", ["1", "40"])
def test_passages_equal_brute_force(spark, seed, partitions):
    texts = _corpus(seed)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert _found(repeated_passages(spark.createDataFrame(texts, SCHEMA)).collect()) == _plain(texts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_passage_of_most_documents(spark):
    rng = random.Random(7)
    passage = _words(rng, 70)
    texts = [(i, " ".join(_words(rng, 60) + passage + _words(rng, 60))) for i in range(200)]
    assert _found(repeated_passages(spark.createDataFrame(texts, SCHEMA).repartition(5)).collect()) == _plain(texts)


def test_passages_around_a_phrase_of_many_documents(spark):
    """Pairs of documents share 30 words of their own before or behind a phrase that all have."""
    rng = random.Random(8)
    phrase = _words(rng, 25)
    texts = []
    for i in range(150):
        own = _words(rng, 30)
        passage = own + phrase if i % 2 else phrase + own
        texts += [(2 * i + d, " ".join(_words(rng, 40) + passage + _words(rng, 40))) for d in (0, 1)]
    rows = spark.createDataFrame(texts, SCHEMA).repartition(5)
    plain = _plain(texts)
    assert len(plain) == 300
    assert _found(repeated_passages(rows).collect()) == plain


def test_one_copy_of_each_passage_is_kept(spark):
    """Shared by two documents, and by so many that its first words are frequent."""
    rng = random.Random(12)
    rare, frequent = _words(rng, 80), _words(rng, 80)
    texts = [(i, " ".join(_words(rng, 30) + frequent + _words(rng, 30))) for i in range(40, 60)]
    texts += [(i, " ".join(_words(rng, 30) + rare)) for i in (7, 5)]
    got = repeated_passages(spark.createDataFrame(texts, SCHEMA)).collect()
    assert sorted(r.doc_id for r in got if r.kept) == [5, 40]
    assert {r.doc_id: r.first_holder for r in got} == {i: 40 if i >= 40 else 5 for i, _ in texts}


def test_full_filters_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(hash_filter, "MOST_BITS", 1 << 10)
    texts = _corpus(5)
    assert _found(repeated_passages(spark.createDataFrame(texts, SCHEMA)).collect()) == _plain(texts)


def test_every_run_holds_a_minimiser():
    rng = random.Random(3)
    own = _words(rng, 400) + ["same"] * 120 + _words(rng, 100)
    found = words(pa.array([" ".join(own)]))
    chosen = set(minimisers(found)[0].tolist())
    assert all(chosen & set(range(i, i + LEAST - suffix_dedup.GRAM + 1)) for i in range(len(own) - LEAST + 1))
    assert len(chosen & set(range(400))) < 60


def test_odd_documents(cluttered, odd_rows):
    got = {r.doc_id for r in repeated_passages(cluttered).collect()}
    assert got == {6, 7, 8}


def test_rows_of_one_id_are_one_document(spark):
    text = " ".join(_words(random.Random(2), 60))
    assert repeated_passages(spark.createDataFrame([(1, text), (1, text)], SCHEMA)).count() == 0
    got = repeated_passages(spark.createDataFrame([(1, text), (None, text), (None, text + " more")], SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.first_word, r.end_word) for r in got) == [(0, 0, 60), (0, 0, 60), (1, 0, 60)]


def test_empty(empty):
    assert repeated_passages(empty).count() == 0
