"""Substring dedup by paragraphs: MinHash bands, exact Jaccard, components.

A unit is a paragraph (a line) of at least ``LEAST_WORDS`` words. Texts are cut into pieces
at places that their own words choose, too, so that a passage inside different paragraphs or over
several short ones is found; equal pieces are extended over the words beside them that agree, and count if
neighbouring ones add up to ``LEAST_WORDS`` words with that. Such a passage is sure to be found from 50 words on;
a shorter one is missed where it holds fewer than two cuts. Equal units are one content from the start. Contents of paragraphs that collide in one
of ``BANDS`` bands are candidates; the exact Jaccard similarity of their sets of five-word shingles
decides; linked contents are clustered by components, and of every cluster the first unit (by document
and place) stays.

With three rows a band and seven bands, a pair at the similarity 0.8 collides with probability 0.993, one at
0.9 with 0.9999. Within a band's key the ``LEADERS`` least contents are compared with each other, and any
further one with the least. The map side does the same and sends ``LEADERS`` rows of a key at most, so a key
that a third of all paragraphs share reaches its task as a few rows from each map task. The contents
of a large key look for their kind by their rarest shingles: two sets of that similarity share one of
the rarest fifth of each, by one order of all shingles, so variants that differ everywhere meet nobody. All pairs of such
a shingle are covered, in rounds of more and more leaders: ``LATE_LEADERS`` at first, in the end all. Before each round components
are found anew, and only contents of different ones are compared, so pairs grow with the square of a group only where
its contents stay apart.

Defined results: NULL, empty and short texts have no unit; repeated rows and equal paragraphs of one
document count as copies of each other; NULL ids take part; empty input gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tallyline.llm.arrow_words import Words, blocks, mixed, words
from tallyline.llm.components import connected_components
from tallyline.llm.hash_filter import HashFilter, hash_filter
from tallyline.llm.tables import shuffles_dropped, written

LEAST_WORDS = 20
SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 7
BAND_ROWS = 3
# Texts are cut into pieces where the hash of three words is the least within REACH words on both sides.
REACH = 3
# Contents of a band's key that are compared with each other; of a rare shingle that any is compared with in the
# first round, and how many times more have been after each further one.
LEADERS = 8
LATE_LEADERS = 32
LATE_GROWTH = 8
SEED = 5
# Keys that a map task remembers before it starts anew.
_KEYS = 1 << 19
_UNIT = "kind string, content long, doc_id long, text_no long, same long, word int, start int, end int, n_words int, key long, leader long"
_COLUMNS = [field.split()[0] for field in _UNIT.split(", ")]


def _shingles(found: Words, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All shingle hashes of the units (runs of words), and the number in each."""
    grams = found.grams(SHINGLE_WORDS)
    counts = last - first - SHINGLE_WORDS + 1
    at = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    return grams[at], counts


def _content(found: Words, first: np.ndarray, last: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit name of each run of words: its words in order."""
    size = last - first
    at = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
    place = (at - np.repeat(first, size)).astype(np.uint64)
    with np.errstate(over="ignore"):
        power = mixed(place * np.uint64(2) + np.uint64(salt)) | np.uint64(1)
        total = np.add.reduceat(found.hash[at] * power, np.cumsum(size) - size)
        return mixed(total + size.astype(np.uint64)).view(np.int64)


def _paragraphs(found: Words) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(found.new_line)
    last = np.r_[first[1:], len(found.hash)][: len(first)]
    enough = last - first >= LEAST_WORDS
    return first[enough], last[enough]


def _cuts(found: Words) -> np.ndarray:
    n = len(found.hash)
    least = np.ones(n, bool)
    rank = mixed(found.grams(3) + np.uint64(77))  # of three words: a frequent one alone would leave no cut
    for step in range(1, REACH + 1):
        near = found.doc[step:] == found.doc[:-step]
        least[step:] &= near & (rank[step:] < rank[:-step])
        least[:-step] &= near & (rank[:-step] <= rank[step:])
        least[:step] = least[n - step :] = False
    return np.flatnonzero(least)


def _pieces(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Runs between neighbouring cuts of one text.

    A cut depends on some ``REACH`` words around it only, so a passage is cut alike wherever it stands;
    what lies before the first and behind the last cut belongs to no piece, see :func:`_further`.
    """
    cut = _cuts(found)
    a, b = cut[:-1], cut[1:]
    good = found.doc[a] == found.doc[b]
    return a[good], b[good]


class _Signer:
    def __init__(self):
        random = np.random.default_rng(SEED)
        self.odd = random.integers(0, 2**63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def keys(self, shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The band keys of each unit: a hash of the band's number and least values."""
        begin = np.cumsum(counts) - counts
        with np.errstate(over="ignore"):
            least = [np.minimum.reduceat(mixed(shingles * odd), begin) for odd in self.odd]
            out = np.empty((len(counts), BANDS), np.uint64)
            for band in range(BANDS):
                key = np.full(len(counts), band + 1, np.uint64)
                for value in least[band * BAND_ROWS : (band + 1) * BAND_ROWS]:
                    key = mixed(key + value)
                out[:, band] = key
        return out.view(np.int64)


def _piece_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``text`` -> ``content, n``: the contents of pieces and their number, block by block."""
    for batch in batches:
        for _, block in blocks(batch.column(0)):
            found = words(block)
            first, last = _pieces(found)
            if len(first):
                contents, counts = np.unique(_content(found, first, last, 3), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(contents), pa.array(counts)], ["content", "n"])


def _repeated_pieces(documents: DataFrame) -> HashFilter:
    """Holds the contents of all pieces with several places, so that few others are ever a row with its place."""
    counts = documents.select("text").mapInArrow(_piece_counts, "content long, n long").groupBy("content").agg(F.sum("n").alias("n"))
    return hash_filter(written(counts.filter("n > 1").select("content"), "paragraph-repeated"), "content")


def _units(batches: Iterator[pa.RecordBatch], repeated: HashFilter) -> Iterator[pa.RecordBatch]:
    """``doc_id, text, same`` -> rows of kind 'unit' and 'piece' (places), 'key' (key, content), 'pair' (content, leader) and 'crowd' (key).

    Of the pieces those that ``repeated`` holds: all that have copies and a few others.
    """
    signer = _Signer()
    leaders: dict[int, list[int]] = {}
    crowds: set[int] = set()
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        for at, block in blocks(batch.column(1)):
            found = words(block)
            if not len(found.hash):
                continue
            ids, numbers = batch.column(0).slice(at, len(block)), number + np.arange(len(block))
            same = batch.column(2).slice(at, len(block))
            number += len(block)
            first, last = _paragraphs(found)
            a, b = _pieces(found)
            if len(a):
                piece = _content(found, a, b, 3)
                again = repeated.holds(piece.view(np.uint64))
                yield from _rows("piece", found, ids, numbers, same, a[again], b[again], piece[again])
            if not len(first):
                continue
            content = _content(found, first, last, 1)
            yield from _rows("unit", found, ids, numbers, same, first, last, content)
            keys = signer.keys(*_shingles(found, first, last))
            if len(leaders) > _KEYS:
                leaders.clear()
                crowds.clear()
            fresh, paired, crowded = [], set(), []
            for name, own in zip(content.tolist(), keys.tolist()):
                for key in own:
                    known = leaders.get(key)
                    if known is None:
                        leaders[key] = [name]
                    elif name in known:
                        continue
                    elif len(known) < LEADERS:
                        known.append(name)
                    else:
                        paired.add((name, known[0]))
                        if key not in crowds:
                            crowds.add(key)
                            crowded.append(key)
                        continue
                    fresh.append((key, name))
            yield _short("key", [k for k, _ in fresh], [c for _, c in fresh], None)
            yield _short("pair", None, [c for c, _ in paired], [leader for _, leader in paired])
            yield _short("crowd", crowded, [None] * len(crowded), None)


def _rows(
    kind: str, found: Words, ids: pa.Array, numbers: np.ndarray, same: pa.Array, first: np.ndarray, last: np.ndarray, content: np.ndarray
) -> Iterator[pa.RecordBatch]:
    if len(first):
        n, doc = len(first), found.doc[first]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([kind] * n),
                pa.array(content),
                ids.take(pa.array(doc)),
                pa.array(numbers[doc]),
                same.take(pa.array(doc)),
                pa.array((first - found.first[doc]).astype(np.int32)),
                pa.array(found.start[first].astype(np.int32)),
                pa.array(found.end[last - 1].astype(np.int32)),
                pa.array((last - first).astype(np.int32)),
                pa.nulls(n, pa.int64()),
                pa.nulls(n, pa.int64()),
            ],
            _COLUMNS,
        )


def _short(kind: str, key: list | None, content: list, leader: list | None) -> pa.RecordBatch:
    n = len(content)
    none = pa.nulls(n, pa.int64())
    wide = [pa.array([kind] * n, pa.string()), pa.array(content, pa.int64()), none, none, none, *[pa.nulls(n, pa.int32())] * 4]
    wide += [none if key is None else pa.array(key, pa.int64()), none if leader is None else pa.array(leader, pa.int64())]
    return pa.RecordBatch.from_arrays(wide, _COLUMNS)


def _lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, content`` sorted by both -> pairs of the first ``LEADERS`` contents of a key, and of each further one with
    the first. No group is held: of the last key of a batch its first contents go on to the next one.
    """
    held, count, last = np.zeros(0, np.int64), 0, None  # of the key that a batch ended with
    for batch in batches:
        key, content = (batch.column(i).to_numpy() for i in range(2))
        if not len(key):
            continue
        again = np.r_[last == (key[0], content[0]), (key[1:] == key[:-1]) & (content[1:] == content[:-1])]
        prefix = len(held) if last is not None and key[0] == last[0] else 0
        before, last = last, (key[-1], content[-1])
        key, content = key[~again], content[~again]
        if prefix:
            key, content = np.r_[np.full(prefix, before[0]), key], np.r_[held, content]
        index = np.arange(len(key))
        start = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]][: len(key)], index, 0))
        place = index - start
        if prefix:
            place += np.where((start == 0) & (index >= prefix), count - prefix, 0)
        new = index >= prefix
        parts = [(index[new & (place >= LEADERS)], None)]
        for step in range(1, LEADERS):
            inside = new & (place < LEADERS) & (place >= step)
            parts.append((index[inside], index[inside] - step))
        a = np.concatenate([p for p, _ in parts])
        b = np.concatenate([start[p] if q is None else q for p, q in parts])
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[a]), pa.array(content[a]), pa.array(content[b]), pa.array(place[a] >= LEADERS)],
            ["key", "content", "leader", "goes_on"],
        )
        if len(key):
            first = start[-1]
            held, count = content[first : first + LEADERS], int(place[-1]) + 1


_PAIRED = "key long, content long, leader long, goes_on boolean"


def _led(rows: DataFrame) -> DataFrame:
    """``key, content`` -> pairs ``content, leader`` and whether the content seeks on if it is unlike its leader."""
    keyed = rows.select("key", "content").repartition("key").sortWithinPartitions("key", "content")
    return keyed.mapInArrow(_lead, _PAIRED)


def _by_rare_shingles(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``content`` -> ``key, content`` for the rarest shingles of each set.

    Sets x and y of that similarity share at least ``similarity * |x|`` shingles, so one of the
    ``|x| - ceil(similarity * |x|) + 1`` first of each, in any order that both follow.
    """
    rows = members.join(sets, "content")
    each = rows.select("content", F.size("shingles").alias("n"), F.explode("shingles").alias("key"))
    counts = written(each.groupBy("key").agg(F.count("content").alias("times")), "paragraph-shingles")
    place = F.row_number().over(Window.partitionBy("content").orderBy("times", "key"))
    ranked = each.join(counts, "key").withColumn("place", place)
    prefix = F.col("n") - F.ceil(F.col("n") * F.lit(similarity) - 1e-9) + 1
    return ranked.filter((F.col("place") <= prefix) & (F.col("times") > 1)).select("key", "content")


def _sets(documents: DataFrame, contents: DataFrame, units: DataFrame) -> DataFrame:
    """``content, shingles`` (distinct hashes) of the given contents, from one unit of each."""
    where = units.filter("kind = 'unit'").join(contents, "content", "left_semi")
    one = where.groupBy("content").agg(F.min(F.struct("doc_id", "start", "end")).alias("at")).select("content", "at.*")
    wanted = one.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end", "content")).alias("wanted"))
    wanted = written(wanted, "paragraph-wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, block in blocks(batch.column(0)):
                found = words(block)
                if not len(found.hash):
                    continue
                first, last = _paragraphs(found)
                content = _content(found, first, last, 1) if len(first) else np.zeros(0, np.int64)
                asked = batch.column(1).slice(at, len(block)).to_pylist()
                names = {(d, w["start"]): w["content"] for d, own in enumerate(asked) for w in own}
                place = [i for i, (d, s) in enumerate(zip(found.doc[first].tolist(), found.start[first].tolist())) if names.get((d, s)) == content[i]]
                first, last, content = first[place], last[place], content[place]
                if not len(place):
                    continue
                shingles, counts = _shingles(found, first, last)
                ends = np.cumsum(counts)
                sets = [np.unique(shingles[b - n : b]).view(np.int64) for b, n in zip(ends.tolist(), counts.tolist())]
                offsets = np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(content), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))],
                    ["content", "shingles"],
                )

    same = documents["doc_id"].eqNullSafe(wanted["doc_id"])
    texts = documents.select("doc_id", "text").join(wanted, same).select("text", "wanted")
    return texts.mapInArrow(run, "content long, shingles array<long>").dropDuplicates(["content"])


def _similar(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Pairs ``a, b`` whose sorted sets have at least the given Jaccard similarity."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = x.values.to_numpy(), y.values.to_numpy()
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(both >= least * (len(x) + len(y) - both))
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])


def near_paragraph_links(documents: DataFrame, units: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Edges ``a, b`` between contents of paragraphs whose shingle sets are similar enough."""
    led = written(_led(units.filter("kind = 'key'")), "paragraph-led")
    paired = units.filter("kind = 'pair'").select(F.col("leader").alias("key"), "content", "leader", F.lit(True).alias("goes_on"))
    open_pairs = written(led.unionByName(paired), "paragraph-open")
    either = open_pairs.select("content").unionByName(open_pairs.select(F.col("leader").alias("content"))).distinct()
    sets = written(_sets(documents, either, units), "paragraph-sets")
    links = _verified(open_pairs, sets, similarity)
    # Every content of a key with more than LEADERS of them, whatever its place there.
    further = open_pairs.filter("goes_on")
    crowded = written(led.filter("goes_on").select("key").unionByName(units.filter("kind = 'crowd'").select("key")).distinct(), "paragraph-crowded")
    of_keys = units.filter("kind = 'key'").join(crowded, "key", "left_semi").select("content")
    members = further.select("content").unionByName(of_keys).distinct()
    if members.isEmpty():
        return links
    groups = written(_by_rare_shingles(members, sets, similarity), "paragraph-rare")
    most = groups.groupBy("key").count().agg(F.max("count")).first()[0] or 0
    done, window = 0, LATE_LEADERS
    while done < most:
        roots = written(connected_components(links, "paragraph-late"), "paragraph-late-roots")
        rows = _mixed(groups, roots, done)
        if rows.isEmpty():
            break
        pairs = written(_apart(rows, done, window), "paragraph-late")
        links = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(_verified(pairs, sets, similarity))
        done, window = window, window * LATE_GROWTH
    return links


def _mixed(groups: DataFrame, roots: DataFrame, done: int) -> DataFrame:
    """``key, content, root, place, n, other`` of the keys with several components and pairs left; ``other``: not of the key's largest one."""
    named = groups.join(roots.select(F.col("node").alias("content"), "root"), "content", "left")
    named = named.select("key", "content", F.coalesce("root", "content").alias("root"), F.xxhash64("content").alias("place"))
    named = written(named, "paragraph-late-named")
    sizes = written(named.groupBy("key", "root").agg(F.count("content").alias("n")), "paragraph-late-sizes")
    main = F.max_by("root", F.struct("n", "root")).alias("main")
    keys = sizes.groupBy("key").agg(main, F.sum("n").alias("n"), F.count("root").alias("roots"))
    keys = written(keys.filter((F.col("roots") > 1) & (F.col("n") > done)).drop("roots"), "paragraph-late-keys")
    return written(named.join(keys, "key").withColumn("other", F.expr("root <> main")).drop("main"), "paragraph-late-rows")


def _apart(rows: DataFrame, done: int, window: int) -> DataFrame:
    """Pairs ``content, leader`` of one key and of different components, for the leaders of this round.

    By a hash of the content, ``window`` contents of each key on average have led when the round ends, and ``done`` before it.
    A pair belongs to the round in which its first one leads, so the last round, where all do, leaves none out. One of
    two different components is not the largest of its key, so the contents of the largest one are not joined with each other.
    """
    rank = (F.col("place") / F.lit(2.0**64) + 0.5) * F.col("n")
    leads = rows.filter((rank >= done) & ((rank < window) | (F.col("n") <= window)))
    leads = leads.selectExpr("key", "content AS leader", "root AS its", "place AS before", "other AS apart")
    later = F.expr("root <> its AND (before < place OR before = place AND leader < content)")
    small = rows.filter("other").join(leads.filter("NOT apart"), "key").filter(later)
    large = rows.join(leads.filter("apart"), "key").filter(later)
    return small.select("content", "leader").unionByName(large.select("content", "leader")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs that are similar enough, as edges ``a, b``."""
    a = sets.select("content", F.col("shingles").alias("x"))
    b = sets.select(F.col("content").alias("leader"), F.col("shingles").alias("y"))
    sides = pairs.select("content", "leader").distinct().join(a, "content").join(b, "leader")
    similar = sides.select("content", "leader", "x", "y").mapInArrow(lambda rows: _similar(rows, similarity), "a long, b long")
    return written(similar, "paragraph-linked")


def _place(at: str) -> str:
    """The order of places: rows without an id come last, and rows of one id or of none follow one another."""
    return f"struct(doc_id IS NULL AS unknown, doc_id, text_no, {at} AS at)"


def repeated_units(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row for every unit that has copies: ``doc_id, kind, start, end, n_words, class_id, copies, removed``.

    Offsets count code points of the text. All units of a class but the first are removed, by document, row and place: of
    repeated rows and of equal units without an id one stays, too.
    """
    with shuffles_dropped(documents.sparkSession):
        return _repeated_units(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), similarity)


def _repeated_units(documents: DataFrame, similarity: float) -> DataFrame:
    named_texts = documents.withColumn("same", F.xxhash64("text"))
    repeated = _repeated_pieces(documents)
    units = written(named_texts.mapInArrow(lambda rows: _units(rows, repeated), _UNIT), "paragraph-units")
    roots = connected_components(near_paragraph_links(documents, units, similarity), "paragraphs")
    places = units.filter("kind IN ('unit', 'piece')")
    counts = places.groupBy("kind", "content").agg(F.count("start").alias("n"), F.min(F.expr(_place("start"))).alias("first"))
    roots = written(roots.select(F.col("node").alias("content"), "root", F.lit("unit").alias("kind")), "paragraph-roots")
    classes = counts.join(roots, ["kind", "content"], "left").withColumn("class_id", F.coalesce("root", "content"))
    classes = written(classes.filter("n > 1 OR root IS NOT NULL"), "paragraph-classes")
    totals = classes.groupBy("kind", "class_id").agg(F.sum("n").alias("copies"), F.min("first").alias("first"))
    named = written(
        classes.select("kind", "content", "class_id", "n").join(totals.filter("copies > 1"), ["kind", "class_id"]), "paragraph-named"
    )
    found = places.select("kind", "content", "doc_id", "text_no", "same", "word", "start", "end", "n_words").join(named, ["kind", "content"])
    # Neighbouring pieces of a text, paragraphs each on their own.
    by_word = Window.partitionBy("text_no", "kind").orderBy("word")
    apart = F.col("word") != F.lag(F.col("word") + F.col("n_words")).over(by_word)
    opens = F.coalesce(apart | (F.col("kind") == "unit"), F.lit(True))
    closes = F.coalesce(F.col("word") + F.col("n_words") != F.lead("word").over(by_word), F.lit(True))
    found = found.select("*", opens.alias("opens"), closes.alias("closes"))
    found = written(found.withColumn("run", F.sum(F.col("opens").cast("int")).over(by_word)), "paragraph-found")
    columns = ["doc_id", "kind", "text_no", "run", "at", "start", "end", "n_words", "class_id", "copies", "first", "n"]
    rows = found.withColumn("at", F.col("start")).select(columns).unionByName(_extended(named_texts, found.filter("kind = 'piece'")).select(columns))
    # A run inside equal paragraphs, with no other copies than theirs, says nothing that they don't.
    until_here = Window.partitionBy("text_no").orderBy("start", F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("unit", F.last(F.expr("IF(kind = 'unit', struct(end, n), NULL)"), True).over(until_here))
    rows = rows.withColumn("says_more", F.expr("kind = 'unit' OR NOT coalesce(end <= unit.end AND copies = unit.n, false)"))
    by_run = Window.partitionBy("text_no", "kind", "run")
    rows = rows.select("*", F.sum("n_words").over(by_run).alias("whole"), F.max("says_more").over(by_run).alias("counts"))
    return rows.filter(F.col("counts") & (F.col("whole") >= LEAST_WORDS)).select(
        "doc_id", "kind", "start", "end", "n_words", "class_id", "copies", F.expr(f"{_place('at')} <> first").alias("removed")
    )


def _extended(texts: DataFrame, pieces: DataFrame) -> DataFrame:
    """The words before the first and behind the last piece of each run that another place of the same piece has too.

    Rows like those of ``pieces``. The class is that of the piece with so many words beside it; a place with still more
    words in common stands in the class of those, and counts here as a copy and as a possible first.
    """
    sides = pieces.groupBy("content").agg(F.max("opens").alias("before"), F.max("closes").alias("behind")).filter("before OR behind")
    own = ["doc_id", "same", "text_no", "content", "start", "end", "opens", "closes"]
    asked = pieces.select(own).join(written(sides, "paragraph-sides"), "content")
    places = F.collect_set(F.struct("content", "start", "end", "before", "behind")).alias("wanted")
    run_ends = [F.collect_set(F.expr(f"IF({of}, start, NULL)")).alias(of) for of in ("opens", "closes")]
    # Of repeated rows the first stands for all.
    wanted = written(asked.groupBy("doc_id", "same").agg(places, F.min("text_no").alias("text_no"), *run_ends), "paragraph-asked")
    both = texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["same"] == wanted["same"])
    places = texts.join(wanted, both).select(texts["doc_id"], texts["same"], "text", "wanted", "text_no", "opens", "closes")
    beside = written(places.mapInArrow(_further, _BESIDE), "paragraph-beside")
    # Places with the same words as far as they go are one context; only contexts become a row for each length.
    known = F.first("hashes", True).alias("hashes")
    at_end = F.max(F.expr("edges IS NOT NULL")).alias("ends")
    contexts = beside.groupBy("context").agg(known, at_end, F.count("piece").alias("n"), F.min(F.expr(_place("piece"))).alias("first"))
    contexts = written(contexts, "paragraph-contexts")
    each = contexts.select("context", "ends", "n", "first", F.posexplode("hashes").alias("fewer", "class_id"))
    classes = each.groupBy("class_id").agg(F.sum("n").alias("copies"), F.min("first").alias("first")).filter("copies > 1")
    longest = F.max(F.struct(F.expr("fewer + 1 AS n_words"), "class_id", "copies", "first")).alias("most")
    shared = each.filter("ends").select("context", "fewer", "class_id").join(written(classes, "paragraph-shared"), "class_id")
    most = written(shared.groupBy("context").agg(longest), "paragraph-most")
    far = "edges[most.n_words]"
    ends = [F.expr(f"IF(is_before, {far}, edges[0]) AS start"), F.expr(f"IF(is_before, edges[0], {far}) AS end")]
    found = beside.filter("edges IS NOT NULL").join(most, "context").select("doc_id", "same", "piece", "is_before", "most.*", *ends)
    widest = F.max(F.struct("n_words", "start", "end", "class_id", "copies", "first")).alias("most")
    found = found.groupBy("doc_id", "same", "piece", "is_before").agg(widest).select("doc_id", "same", "piece", "is_before", "most.*")
    edge = pieces.filter("opens OR closes").select(F.col("doc_id").alias("id"), F.col("same").alias("text"), "kind", "text_no", "run", F.col("start").alias("at"), "opens", "closes")
    beside_run = F.expr("id <=> doc_id AND text = same AND at = piece AND IF(is_before, opens, closes)")
    columns = ["doc_id", "kind", "text_no", "run", "at", "start", "end", "n_words", "class_id", "copies", "first"]
    return edge.join(found, beside_run).select(*columns, F.col("copies").alias("n"))


_BESIDE = "doc_id long, same long, text_no long, piece int, is_before boolean, context long, hashes array<long>, edges array<int>"


def _further(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, same, text, wanted, text_no, opens, closes`` -> a row for each side of a wanted piece with words beside it.

    They reach as far as a passage can go that does not hold the next cut with all the words it depends on. ``hashes``:
    of the piece with 1, 2, 3 and more of them, in one row at least of each ``context``, the last of these; ``edges``, at the
    end of a run only: where the words begin beside the piece, and where each of them ends, seen from the piece.
    """
    known: set[int] = set()
    for batch in batches:
        for at, block in blocks(batch.column(2)):
            found = words(block)
            lists = batch.column(3).slice(at, len(block))
            asked = lists.flatten()
            doc = np.repeat(np.arange(len(block)), np.array(pc.list_value_length(lists)))
            if not len(doc):
                continue
            content, start, end, before, behind = (asked.field(i).to_numpy(zero_copy_only=False) for i in range(5))
            # Words by text and place, as one ascending number.
            wide = int(max(found.end.max(), 1)) + 1
            first = np.searchsorted(found.doc * wide + found.start, doc * wide + start)
            last = np.searchsorted(found.doc * wide + found.end, doc * wide + end) + 1
            cut = _cuts(found)
            own, after = found.first[doc], found.first[doc + 1]
            lower = np.r_[-1, cut][np.searchsorted(cut, first)]
            lower = np.where(lower >= own, np.maximum(lower - REACH, own), own)
            upper = np.r_[cut, len(found.hash)][np.searchsorted(cut, last, "right")]
            upper = np.where(upper < after, np.minimum(upper + REACH + 3, after), after)
            for is_before, use in ((True, before), (False, behind)):
                at_ends = batch.column(5 if is_before else 6).slice(at, len(block))
                of = np.repeat(np.arange(len(block)), np.array(pc.list_value_length(at_ends)))
                ends = np.isin(doc * wide + start, of * wide + at_ends.flatten().to_numpy())
                size = first - lower if is_before else upper - last
                piece = np.flatnonzero(use & (size > 0))
                if not len(piece):
                    continue
                size, ends = size[piece], ends[piece]
                begin = np.cumsum(size) - size
                hashes = np.empty(size.sum(), np.uint64)
                total = mixed(content[piece].view(np.uint64) + np.uint64(11 if is_before else 13))
                open_, n = np.arange(len(piece)), 0
                while len(open_):
                    word = first[piece[open_]] - n - 1 if is_before else last[piece[open_]] + n
                    total = mixed(total + found.hash[word])
                    hashes[begin[open_] + n] = total
                    n += 1
                    more = size[open_] > n
                    open_, total = open_[more], total[more]
                context = hashes[begin + size - 1].view(np.int64)
                fresh = np.zeros(len(piece), bool)
                for i, name in zip(*(x.tolist() for x in np.unique(context, return_index=True)[::-1])):
                    if name not in known:
                        known.add(name)
                        fresh[i] = True
                if len(known) > _KEYS:
                    known.clear()
                step = np.arange(len(hashes)) - np.repeat(begin, size)
                beside = np.repeat(first[piece] - 1, size) - step if is_before else np.repeat(last[piece], size) + step
                # A further entry in front of each list, for the words' side at the piece.
                places = np.insert((found.start if is_before else found.end)[beside], begin, (found.end if is_before else found.start)[beside[begin]])
                taken = pa.array(doc[piece])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(at, len(block)).take(taken) for i in (0, 1, 4)),
                        pa.array(start[piece].astype(np.int32)),
                        pa.array(np.full(len(piece), is_before)),
                        pa.array(context),
                        _lists(hashes.view(np.int64), size, fresh),
                        _lists(places.astype(np.int32), size + 1, ends),
                    ],
                    [field.split()[0] for field in _BESIDE.split(", ")],
                )


def _lists(values: np.ndarray, size: np.ndarray, kept: np.ndarray) -> pa.Array:
    """Lists of the given sizes; those not kept are NULL."""
    offsets = np.r_[0, np.cumsum(np.where(kept, size, 0))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[np.repeat(kept, size)]), mask=pa.array(~kept))
