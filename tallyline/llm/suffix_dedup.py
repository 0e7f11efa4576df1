"""Repeated passages by sparse suffix arrays.

Suffixes are kept at the minimisers of a text only: the places whose hash of ``GRAM`` words is the least
of some window. The window is such that every run of ``LEAST_WORDS`` words holds one, and
the same one wherever the run stands. A first pass counts the first words of all; two filters of a fixed limit tell the later
passes which of them repeat, and which often, so no text is shuffled. Suffixes whose first
words have at most ``FEW`` places are dealt by these words and sorted by what follows them, then by what stands before
them, and each is compared with all others of its first words: to the right as far as both agree, then to the left. Context
is ``LEAST_WORDS - GRAM`` words each way: that much decides whether a passage is long enough, and longer ones are the union
of what their minimisers find.

First words of more places (a common line) are not compared place by place: every run of ``LEAST_WORDS`` words with
that minimiser is named by a hash, and the names that two documents have are kept. Rows grow with the
words and not with pairs, and a name that many documents have is aggregated on the map side. Together the places give every
passage of at least ``LEAST_WORDS`` words that another document has too. What a filter lets pass wrongly is a suffix without a
neighbour, or a frequent one in place of a rare one: more rows, the same passages.

Defined results: NULL, empty and short texts have no passage; documents without an id are told apart by
their text; rows of one id are one document, and only matches between different ones count; empty
input gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyline.llm.arrow_words import Words, blocks, words
from tallyline.llm.hash_filter import HashFilter, hash_filter
from tallyline.llm.tables import written

LEAST_WORDS = 50
GRAM = 8
CONTEXT = LEAST_WORDS - GRAM
# Places of the same first words that are compared with each other.
FEW = 9
_SUFFIX = "key long, right binary, left binary, who long, doc_id long, at int"
_FOUND = "who long, doc_id long, first int, last int, least long"
_RUN = "name long, who long, doc_id long, first int"


def _sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The least (greatest) of each ``width`` neighbouring values, by doubling spans."""
    pick = np.minimum if least else np.maximum
    span, out = 1, values
    while span * 2 <= width:
        out = pick(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def minimisers(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of the minimisers of all texts, and the hashes of the words from there on."""
    n, width = len(found.hash), LEAST_WORDS - GRAM + 1
    if n < LEAST_WORDS:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = found.grams(GRAM)[: n - GRAM + 1]
    least = _sliding(grams, width, True)  # of the window that starts at each word
    whole = found.runs(LEAST_WORDS)[: len(least)]
    # A place is chosen if a whole window's least hash is its own.
    least = np.where(whole, least, np.uint64(0))
    padded = np.r_[np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)]
    chosen = np.flatnonzero(_sliding(padded, width, False)[: len(grams)] == grams)
    return chosen, grams[chosen]


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``text`` -> ``key, n``: the first words of the minimisers and their number, block by block."""
    for batch in batches:
        for _, block in blocks(batch.column(0)):
            keys, counts = np.unique(minimisers(words(block))[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["key", "n"])


def _suffixes(batches: Iterator[pa.RecordBatch], few: HashFilter, many: HashFilter) -> Iterator[pa.RecordBatch]:
    """``who, doc_id, text`` -> the suffixes with few places of their first words, and their context as four bytes a word."""
    for batch in batches:
        for start, block in blocks(batch.column(2)):
            found = words(block)
            place, key = minimisers(found)
            chosen = few.holds(key) & ~many.holds(key)
            place, key = place[chosen], key[chosen]
            if not len(place):
                continue
            doc = found.doc[place]
            at = place - found.first[doc]
            short = (found.hash >> np.uint64(32)).astype(">u4")
            ahead = np.minimum(CONTEXT, found.first[doc + 1] - place - GRAM)
            behind = np.minimum(CONTEXT, at)
            step = np.arange(CONTEXT)
            limit = len(short) - 1
            right = short[np.minimum(place[:, None] + GRAM + step, limit)].tobytes()
            left = short[np.maximum(place[:, None] - 1 - step, 0)].tobytes()
            row = 4 * CONTEXT
            rights = [right[i * row : i * row + 4 * n] for i, n in enumerate(ahead.tolist())]
            lefts = [left[i * row : i * row + 4 * n] for i, n in enumerate(behind.tolist())]
            own = batch.slice(start, len(block))
            taken = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    pa.array(rights, pa.binary()),
                    pa.array(lefts, pa.binary()),
                    own.column(0).take(taken),
                    own.column(1).take(taken),
                    pa.array(at.astype(np.int32)),
                ],
                [f.split()[0] for f in _SUFFIX.split(", ")],
            )


def _padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Context bytes as a matrix of words, and the number of words in each row."""
    items = column.to_pylist()
    row = 4 * CONTEXT
    sizes = np.array([len(x) // 4 for x in items])
    return np.frombuffer(b"".join(x.ljust(row, b"\0") for x in items), np.uint32).reshape(-1, CONTEXT), sizes


def _agreement(words_of: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading words two rows share."""
    same = words_of[a] == words_of[b]
    lead = np.where(same.all(axis=1), CONTEXT, same.argmin(axis=1))
    return np.minimum(lead, np.minimum(sizes[a], sizes[b]))


def _matches(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers with the words before and behind the place that a neighbour shares, where it is enough, and the lesser ``who`` of both."""
    n = rows.num_rows
    key, who = rows.column(0).to_numpy(), rows.column(3).to_numpy()
    right, right_size = _padded(rows.column(1))
    left, left_size = _padded(rows.column(2))
    index = np.arange(n)
    found: list[tuple[np.ndarray, ...]] = []
    for other in [index - s for s in range(1, FEW)]:
        a = index[other >= 0]
        b = other[other >= 0]
        fit = (key[a] == key[b]) & (who[a] != who[b])
        a, b = a[fit], b[fit]
        if not len(a):
            continue
        ahead, behind = _agreement(right, right_size, a, b), _agreement(left, left_size, a, b)
        enough = ahead + behind + GRAM >= LEAST_WORDS
        least = np.minimum(who[a], who[b])
        found += [(side[enough], behind[enough], ahead[enough], least[enough]) for side in (a, b)]
    if not found:
        return index[:0], index[:0], index[:0], index[:0]
    return tuple(np.concatenate([f[i] for f in found]) for i in range(4))


def _passages(rows: pa.RecordBatch) -> pa.RecordBatch:
    """The passages that the neighbours of the rows show, one row for each place and extent."""
    row, behind, ahead, least = _matches(rows)
    at = rows.column(5).to_numpy()[row]
    extent = np.unique(np.stack([row, at - behind, at + GRAM + ahead, least], axis=1), axis=0) if len(row) else np.zeros((0, 4), int)
    taken = pa.array(extent[:, 0])
    columns = [rows.column(3).take(taken), rows.column(4).take(taken)]
    columns += [pa.array(extent[:, i].astype(np.int32)) for i in (1, 2)] + [pa.array(extent[:, 3])]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _FOUND.split(", ")])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key -> the passages that rows of one key share; the last rows of a batch go on to the next one."""
    kept = None
    for batch in batches:
        if batch.num_rows:
            rows = batch if kept is None else pa.Table.from_batches([kept, batch]).combine_chunks().to_batches()[0]
            yield _passages(rows)
            kept = rows.slice(max(0, rows.num_rows - FEW + 1))


def _runs(batches: Iterator[pa.RecordBatch], many: HashFilter) -> Iterator[pa.RecordBatch]:
    """``who, doc_id, text`` -> a name for every run of ``LEAST_WORDS`` words whose minimiser has many places."""
    for batch in batches:
        for start, block in blocks(batch.column(2)):
            found = words(block)
            n, width = len(found.hash), LEAST_WORDS - GRAM + 1
            if n < LEAST_WORDS:
                continue
            least = _sliding(found.grams(GRAM)[: n - GRAM + 1], width, True)
            first = np.flatnonzero(found.runs(LEAST_WORDS)[: len(least)])
            first = first[many.holds(least[first])]
            if not len(first):
                continue
            own = batch.slice(start, len(block))
            taken = pa.array(found.doc[first])
            name = found.grams(LEAST_WORDS)[first].view(np.int64)
            at = (first - found.first[found.doc[first]]).astype(np.int32)
            columns = [pa.array(name), own.column(0).take(taken), own.column(1).take(taken), pa.array(at)]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _RUN.split(", ")])


def _common_runs(texts: DataFrame, many: HashFilter) -> DataFrame:
    """``who, doc_id, first, last, least`` of the runs around frequent first words that several documents have."""
    shared = texts.sparkSession.sparkContext.broadcast(many)
    runs = written(texts.mapInArrow(lambda batches: _runs(batches, shared.value), _RUN), "suffix-runs")
    owners = runs.groupBy("name").agg(F.min("who").alias("least"), F.max("who").alias("most"))
    common = written(owners.filter("least <> most").select("name", "least"), "suffix-shared")
    return runs.join(common, "name").select("who", "doc_id", "first", (F.col("first") + LEAST_WORDS).alias("last"), "least")


def _first_held(passages: DataFrame) -> DataFrame:
    """The passages of which no lesser document is known for some run of ``LEAST_WORDS`` words, ``alone``.

    Rare first words may show a part of the documents only that share a passage; frequent ones beside them show the others. So
    the places where runs start, that lesser documents share, are joined to islands, and a passage must lie inside one.
    """
    starts = passages.selectExpr("who", "doc_id", "first AS s", f"last - {LEAST_WORDS} AS e", "least")
    reach = "max(e) OVER (PARTITION BY who ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    lesser = starts.filter("least < who").selectExpr("*", f"CAST(coalesce(s > {reach} + 1, true) AS INT) AS new")
    lesser = lesser.selectExpr("*", "sum(new) OVER (PARTITION BY who ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island")
    islands = lesser.groupBy("who", "island").agg(F.min("s").alias("s"), F.max("e").alias("island_end")).drop("island")
    own = starts.filter("least = who").select("who", "doc_id", "s", "e").distinct()
    both = own.unionByName(islands, allowMissingColumns=True)
    cover = "last(island_end, true) OVER (PARTITION BY who ORDER BY s, e NULLS FIRST ROWS UNBOUNDED PRECEDING) AS cover"
    alone = both.selectExpr("*", cover).filter("e IS NOT NULL AND coalesce(cover < e, true)")
    return alone.selectExpr("who", "doc_id", "s AS first", f"e + {LEAST_WORDS} AS last", "who AS least", "true AS alone")


def repeated_passages(documents: DataFrame) -> DataFrame:
    """``doc_id, first_word, end_word, n_words, first_holder, kept`` of the passages of each document that another one has too.

    Words are runs without white space, numbered from 0; the end is exclusive. Passages that touch or
    overlap are one row. ``first_holder`` is the least document that any part is shared with, itself included: its id, or the hash of
    its text where it has none. A passage is ``kept`` if its document is the least of those that share some run of ``LEAST_WORDS``
    words of it: of every passage one copy is kept.
    """
    doc_id = F.col("doc_id").cast("long")
    texts = documents.select(F.coalesce(doc_id, F.xxhash64("text")).alias("who"), doc_id.alias("doc_id"), "text")
    counts = texts.select("text").mapInArrow(_keys, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    repeated = written(counts.filter("n > 1"), "suffix-keys")
    few, many = (hash_filter(repeated.filter(f"n {test} {FEW}").select("key"), "key") for test in ("<=", ">"))
    both = documents.sparkSession.sparkContext.broadcast((few, many))
    suffixes = texts.mapInArrow(lambda batches: _suffixes(batches, *both.value), _SUFFIX)
    order = ["key", "right", "left", "who", "at"]
    # Hashes are spread already: to find ranges Spark would run the pass over the texts once more.
    found = suffixes.repartition("key").sortWithinPartitions(*order).mapInArrow(_compare, _FOUND)
    passages = found.unionByName(_common_runs(texts, many)).repartition("who")
    passages = passages.withColumn("alone", F.lit(False)).unionByName(_first_held(passages))
    by_start = Window.partitionBy("who").orderBy("first", "last")
    reach = F.max("last").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    started = passages.withColumn("new", F.coalesce(F.col("first") > reach, F.lit(True)).cast("int"))
    grouped = started.withColumn("run", F.sum("new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        grouped.groupBy("who", "run")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.min("first").alias("first_word"),
            F.max("last").alias("end_word"),
            F.min("least").alias("first_holder"),
            F.bool_or("alone").alias("kept"),
        )
        .select("doc_id", "first_word", "end_word", (F.col("end_word") - F.col("first_word")).alias("n_words"), "first_holder", "kept")
    )


def oracle() -> str:
    """:func:`repeated_passages` in DuckDB's SQL, with words in place of hashes, for documents that have ids."""
    return f"""
WITH texts AS (SELECT doc_id AS who, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
places AS (SELECT who, w, unnest(range(1, len(w) - {LEAST_WORDS - 2})) AS i FROM texts WHERE len(w) >= {LEAST_WORDS}),
runs AS (SELECT who, (i - 1)::INTEGER AS first, array_to_string(w[i : i + {LEAST_WORDS - 1}], ' ') AS run FROM places),
owners AS (SELECT run, min(who) AS least FROM runs GROUP BY run HAVING min(who) <> max(who)),
shared AS (SELECT DISTINCT who, first, least FROM runs JOIN owners USING (run)),
marked AS (SELECT *, (first > coalesce(lag(first) OVER (PARTITION BY who ORDER BY first, least) + {LEAST_WORDS}, -1))::INTEGER AS new FROM shared),
grouped AS (SELECT *, sum(new) OVER (PARTITION BY who ORDER BY first, least ROWS UNBOUNDED PRECEDING) AS run FROM marked)
SELECT who AS doc_id, min(first) AS first_word, (max(first) + {LEAST_WORDS})::INTEGER AS end_word,
  (max(first) + {LEAST_WORDS} - min(first))::INTEGER AS n_words, min(least) AS first_holder, bool_or(least = who) AS kept
FROM grouped GROUP BY who, run"""
