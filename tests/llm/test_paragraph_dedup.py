from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyline.llm import paragraph_dedup
from tallyline.llm.hash_filter import HashFilter
from tallyline.llm.paragraph_dedup import repeated_units

SCHEMA = "doc_id long, text string"


def _words(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(n)]


def _paragraphs(texts):
    """(doc, start) of each paragraph that counts -> its set of shingles."""
    found = {}
    for doc, text in texts:
        start = 0
        for line in (text or "").split("\n"):
            words = line.split()
            if len(words) >= 20:
                found[doc, start + len(line) - len(line.lstrip())] = frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))
            start += len(line) + 1
    return found


def _classes(sets):
    """Components of all pairs with a Jaccard similarity of 0.8 or more, by brute force."""
    names = list(sets)
    label = {n: n for n in names}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for i, a in enumerate(names):
        for b in names[:i]:
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                label[root(a)] = root(b)
    groups = defaultdict(set)
    for n in names:
        groups[root(n)].add(n)
    return {frozenset(g) for g in groups.values() if len(g) > 1}


def _found(rows):
    groups = defaultdict(set)
    for r in rows:
        if r.kind == "unit":
            groups[r.class_id].add((r.doc_id, r.start))
    return {frozenset(g) for g in groups.values()}


def test_classes_equal_brute_force(spark):
    rng = random.Random(21)
    paragraphs = [_words(rng, rng.choice([25, 60, 120])) for _ in range(60)]
    for p in paragraphs[:30]:
        for _ in range(rng.randint(1, 4)):
            copy = list(p)
            for _ in range(rng.choice([0, 0, 1, 2])):
                copy[rng.randrange(len(copy))] = "edited"
            paragraphs.append(copy)
    rng.shuffle(paragraphs)
    texts = [(i, "\n".join(["short line"] + [" ".join(p) for p in paragraphs[i * 3 : i * 3 + 3]])) for i in range(-(-len(paragraphs) // 3))]
    got = repeated_units(spark.createDataFrame(texts, SCHEMA)).collect()
    assert _found(got) == _classes(_paragraphs(texts))
    text_of = dict(texts)
    for r in got:
        assert len(text_of[r.doc_id][r.start : r.end].split()) == r.n_words
    for group in {r.class_id for r in got if r.kind == "unit"}:
        rows = sorted((r for r in got if r.class_id == group), key=lambda r: (r.doc_id, r.start))
        assert [r.removed for r in rows] == [False] + [True] * (len(rows) - 1)
        assert {r.copies for r in rows} == {len(rows)}


def test_a_large_group_of_variants(spark, monkeypatch):
    """Hundreds of different near copies of one paragraph, over few remembered keys."""
    monkeypatch.setattr(paragraph_dedup, "_KEYS", 50)
    rng = random.Random(22)
    base = _words(rng, 100)
    texts = []
    for i in range(300):
        copy = list(base)
        copy[rng.randrange(100)] = f"own{i}"
        texts.append((i, " ".join(copy)))
    texts += [(1000 + i, " ".join(_words(rng, 80))) for i in range(100)]
    got = repeated_units(spark.createDataFrame(texts, SCHEMA).repartition(6)).collect()
    units = [r for r in got if r.kind == "unit"]
    assert {r.doc_id for r in units} == set(range(300)) and len({r.class_id for r in units}) == 1


def _edited(rng, base, places):
    """A version of the paragraph for each place, with another word there."""
    return [" ".join(base[:p] + [f"own{i}{rng.randrange(10**6)}"] + base[p + 1 :]) for i, p in enumerate(places)]


@pytest.mark.parametrize("partitions", [1, 6])
def test_chains_of_edits_equal_brute_force(spark, partitions):
    """Versions alike only if edited at the same or the next place: chains, parted where places are left out."""
    rng = random.Random(24)
    texts = []
    for left_out in [(), (20, 21, 22, 40, 41, 42)]:
        places = [p for p in range(4, 56) if p not in left_out]  # the ends are alike to all
        texts += _edited(rng, _words(rng, 60), [p for p in places for _ in range(4)])
    rng.shuffle(texts)
    texts = list(enumerate(texts))
    classes = _classes(_paragraphs(texts))
    assert len(classes) == 4
    got = repeated_units(spark.createDataFrame(texts, SCHEMA).coalesce(1).repartition(partitions)).collect()
    assert _found(got) == classes


def test_a_passage_inside_different_paragraphs(spark):
    rng = random.Random(23)
    hits = 0
    for i in range(12):
        passage = _words(rng, 60)
        texts = [(d, " ".join(_words(rng, 40) + passage + _words(rng, 50))) for d in (1, 2)] + [(3, " ".join(_words(rng, 150)))]
        got = repeated_units(spark.createDataFrame(texts, SCHEMA)).collect()
        assert {r.kind for r in got} <= {"piece"} and 3 not in {r.doc_id for r in got}
        hits += {1, 2} == {r.doc_id for r in got}
    assert hits >= 11


@pytest.mark.parametrize("size", [50, 55])
def test_short_passages_are_found_with_their_ends(spark, size):
    rng = random.Random(25)
    texts, passages = [], []
    for i in range(300):
        passages.append(" ".join(_words(rng, size)))
        texts += [(2 * i + d, " ".join(_words(rng, 40) + [passages[i]] + _words(rng, 50))) for d in (0, 1)]
    covered = defaultdict(set)
    got = repeated_units(spark.createDataFrame(texts, SCHEMA)).collect()
    text_of = dict(texts)
    for r in got:
        assert r.kind == "piece" and len(text_of[r.doc_id][r.start : r.end].split()) == r.n_words
        assert r.copies == 2 and r.removed == (r.doc_id % 2 == 1)
        covered[r.doc_id].update(range(r.start, r.end))
    for doc, text in texts:
        start = text.index(passages[doc // 2])
        own = {p for p in range(start, start + len(passages[doc // 2])) if text[p] != " "}
        assert own == {p for p in covered[doc] if text[p] != " "}


def test_odd_documents(cluttered, odd_rows):
    got = repeated_units(cluttered).collect()
    sets = defaultdict(list)
    for doc, text, *_ in odd_rows:
        sets[doc].append(text)
    assert {r.doc_id for r in got if r.kind == "unit"} == {6, 7}
    assert 8 in {r.doc_id for r in got}


def test_repeated_rows_and_no_ids(spark):
    text = " ".join(_words(random.Random(2), 30))
    got = repeated_units(spark.createDataFrame([(1, text), (1, text), (None, text)], SCHEMA)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.copies) for r in got) == [(False, 1, 3), (False, 1, 3), (True, 0, 3)]
    assert sorted((r.doc_id is None, r.removed) for r in got) == [(False, False), (False, True), (True, True)]


@pytest.mark.parametrize("ids", [(1, 1), (None, None, 7), (None, None)])
def test_one_copy_stays(spark, ids):
    """Of repeated rows, of rows without an id, and of passages in unlike surroundings."""
    rng = random.Random(31)
    text, passage = " ".join(_words(rng, 30)), " ".join(_words(rng, 70))
    got = repeated_units(spark.createDataFrame([(i, text) for i in ids], SCHEMA).repartition(2)).collect()
    assert [r.copies for r in got] == [len(ids)] * len(ids) and sum(not r.removed for r in got) == 1
    assert [r.doc_id for r in got if not r.removed] == [min((i for i in ids if i is not None), default=None)]
    around = [" ".join(_words(rng, 40)) for _ in range(2)]
    rows = [(i, f"{around[0]} {passage}") for i in ids] + [(9, f"{passage} {around[1]}")]
    got = repeated_units(spark.createDataFrame(rows, SCHEMA)).filter("kind = 'piece'").collect()
    kept = [r for r in got if not r.removed]
    assert min(i for i in (*ids, 9) if i is not None) in {r.doc_id for r in kept}
    assert set(Counter(r.class_id for r in kept).values()) == {1}


@pytest.mark.parametrize("text", [None, "", " \n ", "one line"])
def test_nothing_to_find(spark, text):
    assert repeated_units(spark.createDataFrame([(1, text)], SCHEMA)).count() == 0


def test_empty(empty):
    assert repeated_units(empty).count() == 0


def _tables(monkeypatch):
    """The tables that the operator writes, by name."""
    tables, write = {}, paragraph_dedup.written

    def kept(rows, name):
        tables[name] = write(rows, name)
        return tables[name]

    monkeypatch.setattr(paragraph_dedup, "written", kept)
    return tables


def test_pieces_of_one_place_are_no_rows(spark, monkeypatch):
    tables = _tables(monkeypatch)
    rng = random.Random(41)
    passage = _words(rng, 60)
    texts = [(i, " ".join(_words(rng, 200))) for i in range(40)]
    texts += [(100 + i, " ".join(_words(rng, 40) + passage + _words(rng, 50))) for i in range(2)]
    assert {r.doc_id for r in repeated_units(spark.createDataFrame(texts, SCHEMA)).collect()} == {100, 101}
    pieces = tables["paragraph-units"].filter("kind = 'piece'")
    assert pieces.filter("doc_id >= 100").count() >= 4
    assert pieces.filter("doc_id < 100").count() < 40  # of about a thousand; a hash filter lets some through


def test_words_beside_pieces_are_one_row_for_each_side(spark, monkeypatch):
    tables = _tables(monkeypatch)
    rng = random.Random(42)
    passage = _words(rng, 60)
    texts = [" ".join(_words(rng, 40) + passage + _words(rng, 50)) for _ in range(10)]
    texts = [(i, texts[i % 10]) for i in range(30)]
    got = repeated_units(spark.createDataFrame(texts, SCHEMA)).collect()
    assert {r.doc_id for r in got} == set(range(30)) and 30 in {r.copies for r in got}
    places = tables["paragraph-beside"].select("doc_id", "piece", "is_before")
    assert places.count() == places.distinct().count()
    assert tables["paragraph-contexts"].count() < places.count()


def test_a_full_filter_loses_and_adds_nothing(spark, monkeypatch):
    rng = random.Random(43)
    passages = [_words(rng, 60) for _ in range(5)]
    texts = [(i, " ".join(_words(rng, 30) + passages[i % 5] + _words(rng, 30))) for i in range(15)] + [(20, None), (21, " ".join(passages[0]))]
    rows = spark.createDataFrame(texts, SCHEMA)
    got = repeated_units(rows).collect()
    full = HashFilter(np.full(16, 2**64 - 1, np.uint64))
    monkeypatch.setattr(paragraph_dedup, "_repeated_pieces", lambda documents: full)
    assert got and sorted(got) == sorted(repeated_units(rows).collect())


def test_the_session_keeps_its_settings(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    repeated_units(spark.createDataFrame([(1, "one")], SCHEMA)).collect()
    assert spark.conf.get(name) == before
