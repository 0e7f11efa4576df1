"""Periodic runs of words: maximal stretches that repeat a pattern of words at least three times.

A stretch has period q if words q apart are identical. For each q the words at multiples of q, the harmonic grid, are
compared with those one and two steps on; a run of three periods holds such a triple. How far a triple's match goes is a
longest common extension of two places of one text. These are answered from a difference cover: of every ``MODULUS`` places
only the six of ``COVER`` are sampled, so that for any two places a few words further on both are sampled. Only the sampled
suffixes are sorted, block of ``MODULUS`` words by block, and the least common prefix between two of them is a range
minimum from a sparse table. The words up to the first sampled places and behind the last equal block are compared one by one.

Texts are worked on in blocks of some megabytes, each document in one task; the memory is that of the longest text.
Blocks of words are named by a 64-bit hash; equal names are compared word for word, and named by sorting the words where
the hash fails, so results are exact.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; NULL, empty and blank texts have no words and no runs; repeated rows give
repeated rows; further columns are ignored; empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyline.llm.arrow_words import blocks, mixed

LEAST_WORDS = 24
LEAST_TIMES = 3
# A perfect difference set, every difference modulo 31 occurs once.
MODULUS = 31
COVER = (0, 1, 3, 8, 12, 18)
# Grid triples that are extended at once.
CHUNK = 1 << 19
_BASE = np.uint64(0x9DDFEA08EB382D69)


def _shifts() -> np.ndarray:
    """Words from places of two residues until both are sampled."""
    sampled = np.isin(np.arange(MODULUS), COVER)
    shift = np.full((MODULUS, MODULUS), MODULUS, np.int64)
    for d in range(MODULUS - 1, -1, -1):
        a = np.arange(MODULUS)
        both = sampled[(a + d) % MODULUS][:, None] & sampled[(a + d) % MODULUS][None, :]
        shift[both] = d
    return shift


_SHIFT = _shifts()
_CLASS = np.full(MODULUS, -1, np.int64)
_CLASS[list(COVER)] = np.arange(len(COVER))


class CoverIndex:
    """Longest common extensions of pairs of places in a sequence of numbers."""

    def __init__(self, sequence: np.ndarray) -> None:
        size = len(sequence)
        self.steps = size // MODULUS + 1  # sampled places of each residue
        # Values of their own behind the end: nothing extends beyond it.
        behind = self.steps * MODULUS - size + 2 * MODULUS
        least = min(int(sequence.min(initial=0)), 0)
        self.words = np.r_[sequence, least - 1 - np.arange(behind)]
        self._sort()

    def _names(self, places: np.ndarray) -> np.ndarray:
        """Numbers of the blocks of ``MODULUS`` words at the places: equal for equal blocks."""
        scattered = mixed(self.words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        total = np.zeros(len(places), np.uint64)
        with np.errstate(over="ignore"):
            for t in range(MODULUS):
                total = total * _BASE + scattered[places + t]
        order = np.argsort(total, kind="stable")
        alike = np.flatnonzero(total[order[1:]] == total[order[:-1]])
        a, b = places[order[alike]], places[order[alike + 1]]
        if any((self.words[a + t] != self.words[b + t]).any() for t in range(MODULUS)):
            rows = self.words[places[:, None] + np.arange(MODULUS)]
            return np.unique(rows, axis=0, return_inverse=True)[1].reshape(-1)
        fresh = np.ones(len(places), np.int64)
        fresh[alike + 1] = 0
        names = np.empty(len(places), np.int64)
        names[order] = np.cumsum(fresh) - 1
        return names

    def _sort(self) -> None:
        """Sorts the sampled suffixes by doubling, and the common prefixes of neighbours into a sparse table."""
        steps, count = self.steps, self.steps * len(COVER)
        places = (np.array(COVER)[:, None] + MODULUS * np.arange(steps)[None, :]).reshape(-1)
        step = np.tile(np.arange(steps), len(COVER))
        rank, width, levels = self._names(places), 1, []
        while True:
            levels.append(rank)
            if width >= steps or rank.max(initial=0) == count - 1:
                break
            behind = np.full(count, -1, np.int64)
            inside = np.flatnonzero(step + width < steps)
            behind[inside] = rank[inside + width]
            key = rank * (count + 1) + behind + 1
            rank = np.unique(key, return_inverse=True)[1].reshape(-1)
            width *= 2
        order = np.argsort(rank, kind="stable")
        self.rank = np.empty(count, np.int64)
        self.rank[order] = np.arange(count)
        # Common blocks of neighbours, from the widest level down. No two suffixes are equal up to an end, since the last
        # words have values of their own: equal ranks never reach beyond it.
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(count - 1, np.int32)
        for level in range(len(levels) - 1, -1, -1):
            same = np.flatnonzero(levels[level][a] == levels[level][b])
            for moved in (common, a, b):
                moved[same] += 1 << level
        self.table = [common]
        while 2 << (len(self.table) - 1) <= len(common):
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _common_blocks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal blocks from two sampled places on: the least between their ranks."""
        low, high = np.minimum(self.rank[a], self.rank[b]), np.maximum(self.rank[a], self.rank[b])
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.empty(len(low), np.int64)
        for k in np.unique(level):
            own = np.flatnonzero(level == k)
            found[own] = np.minimum(self.table[k][low[own]], self.table[k][high[own] - (1 << k)])
        return found

    def _sampled(self, places: np.ndarray) -> np.ndarray:
        return _CLASS[places % MODULUS] * self.steps + places // MODULUS

    def _compare(self, i: np.ndarray, j: np.ndarray, length: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Adds up to ``most`` equal words to the lengths; returns which pairs met no difference."""
        alike = np.ones(len(i), bool)
        for t in range(int(most.max(initial=0))):
            active = np.flatnonzero(alike & (most > t))
            if not len(active):
                break
            same = self.words[i[active] + length[active]] == self.words[j[active] + length[active]]
            length[active[same]] += 1
            alike[active[~same]] = False
        return alike

    def extensions(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from the places ``i`` and ``j`` on, which differ."""
        length = np.zeros(len(i), np.int64)
        alike = np.flatnonzero(self._compare(i, j, length, _SHIFT[i % MODULUS, j % MODULUS]))
        at_i, at_j = i[alike] + length[alike], j[alike] + length[alike]
        more = MODULUS * self._common_blocks(self._sampled(at_i), self._sampled(at_j))
        self._compare(at_i, at_j, more, np.full(len(alike), MODULUS))
        length[alike] += more
        return length


def _grid(words: np.ndarray, ends: np.ndarray, periods: range, least: int, times: int) -> Iterator[tuple[np.ndarray, int]]:
    """Grid places where a run may be, for each period.

    ``ends`` are the ends of the documents, longest first. The first grid place of a run has so many matches behind
    it that the next grid place matches as well, and so do the words beside it.
    """
    sizes = np.diff(np.r_[0, ends])
    for q in periods:
        fitting = int(np.searchsorted(-sizes, -max(times * q, least), "right"))
        if not fitting:
            return
        own = words[: ends[fitting - 1]]
        grid = own[::q]
        same = grid[1:] == grid[:-1]
        # Words that match from the first grid place of a run on.
        sure = max(least, times * q) - 2 * q + 1
        met = np.flatnonzero(same[:-1] & same[1:]) * q
        for t in range(1, min(sure, 9)):
            if not len(met):
                break
            met = met[met + q + t < len(own)]
            met = met[own[met + t] == own[met + q + t]]
        if len(met):
            yield met, q


def _runs_of_triples(index: CoverIndex, place: np.ndarray, period: np.ndarray, least: int, times: int) -> np.ndarray:
    """Rows (start, end, period) of the runs around grid places."""
    ahead = index.extensions(place, place + period)
    enough = ahead >= np.maximum(least, times * period) - 2 * period + 1
    place, period, end = place[enough], period[enough], (place + period + ahead)[enough]
    # The first grid place of each stretch: the start is less than a period before it.
    order = np.lexsort((place, end, period))
    place, period, end = place[order], period[order], end[order]
    first = np.r_[True, (period[1:] != period[:-1]) | (end[1:] != end[:-1])][: len(place)]
    place, period, end = place[first], period[first], end[first]
    low, high = np.zeros(len(place), np.int64), np.minimum(period - 1, place)
    while (busy := np.flatnonzero(low < high)).size:
        middle = (low[busy] + high[busy] + 1) // 2
        at = place[busy] - middle
        reaches = at + period[busy] + index.extensions(at, at + period[busy]) == end[busy]
        low[busy[reaches]] = middle[reaches]
        high[busy[~reaches]] = middle[~reaches] - 1
    start = place - low
    long = end - start >= np.maximum(least, times * period)
    return np.c_[start, end, period][long]


def find_runs(texts: Sequence[np.ndarray], least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> list[np.ndarray]:
    """For each text, given as the numbers of its words, rows (start, length, period) by start, then period.

    A run has its smallest period, at least ``least`` words and ``times`` periods (3 or more), and no word beside it keeps the period.
    """
    if times < 3:
        raise ValueError("the grid needs three periods of a run")
    found = [np.zeros((0, 3), np.int64) for _ in texts]
    sizes = np.array([len(text) for text in texts], np.int64)

    def joined(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The chosen texts longest first, each followed by a number of its own."""
        chosen = chosen[np.argsort(-sizes[chosen], kind="stable")]
        parts = [part for k, d in enumerate(chosen) for part in (texts[d], [-1 - k])]
        return chosen, np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64), np.cumsum(sizes[chosen] + 1)

    chosen, words, ends = joined(np.flatnonzero(sizes >= least))
    if not len(chosen):
        return found
    periods = range(1, int(sizes.max()) // times + 1)
    repeating = np.zeros(len(chosen), bool)
    for met, _ in _grid(words, ends, periods, least, times):
        repeating[np.searchsorted(ends, met, "right")] = True
    if not repeating.any():
        return found
    chosen, words, ends = joined(chosen[repeating])
    index = CoverIndex(words)
    rows, held = [], []

    def resolve() -> None:
        if held:
            place = np.concatenate([met for met, _ in held])
            rows.append(_runs_of_triples(index, place, np.repeat([q for _, q in held], [len(met) for met, _ in held]), least, times))
            held.clear()

    for met, q in _grid(words, ends, periods, least, times):
        held.append((met, q))
        if sum(len(m) for m, _ in held) >= CHUNK:
            resolve()
    resolve()
    every = np.concatenate(rows)
    # The least period of each stretch: its multiples give the same one.
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    every = every[np.r_[True, (every[1:, :2] != every[:-1, :2]).any(axis=1)][: len(every)]]
    owner = np.searchsorted(ends, every[:, 0], "right")
    begin = np.r_[0, ends][owner]
    every = np.c_[every[:, 0] - begin, every[:, 1] - every[:, 0], every[:, 2]]
    every = every[np.lexsort((every[:, 2], every[:, 0], owner))]
    for k, own in zip(chosen, np.split(every, np.searchsorted(owner, np.arange(1, len(chosen))))):
        found[k] = own
    return found


def kept_words(size: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay when every run keeps its first period only."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(documents: DataFrame, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every document.

    ``runs`` are (start, length, period) in words by start, then period; ``collapsed`` is the text of single-spaced words
    without those that any run has after its first period.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in blocks(batch.column("text")):
                numbers: dict[bytes, int] = {}
                words = [(text or "").encode().split() for text in texts.to_pylist()]
                coded = [np.array([numbers.setdefault(word, len(numbers)) for word in own], np.int64) for own in words]
                found = find_runs(coded, least, times)
                collapsed = []
                for own, runs in zip(words, found):
                    if len(runs):
                        own = [own[i] for i in np.flatnonzero(kept_words(len(own), runs)).tolist()]
                    collapsed.append(b" ".join(own).decode())
                flat = np.concatenate(found)
                bounds = np.cumsum([0, *map(len, found)])
                structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(_RUN))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(words)),
                        pa.array([len(own) for own in words], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), structs),
                        pa.array(collapsed, pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; ties go to the smallest start, then period."""

    def better(best: Column, run: Column) -> Column:
        own, other = run["length"] * best["period"], best["length"] * run["period"]
        return F.when(best.isNull() | (own > other), run).otherwise(best)

    # Runs come by start and period, so the first of equal ones stays.
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, better)


def runs_text(runs: Column) -> Column:
    """Every run's ``start,length,period`` on a line of its own."""
    line = lambda r: F.concat(F.concat_ws(",", *[r[name].cast("string") for name in ("start", "length", "period")]), F.lit("\n"))
    return F.array_join(F.transform(runs, line), "")


def with_planted_periods(documents: DataFrame) -> DataFrame:
    """``doc_id, text``: in every tenth document, by the CRC-32 of its id, the words from a place on repeat with a period.

    Place and period follow from the hash h: with g = h div 10, n words, a = g mod n and
    p = 1 + (n - a) div (3 + g mod 8), word i >= a becomes the word a + (i - a) mod p. A NULL id or an empty text changes nothing.
    """
    hash_ = F.crc32(F.col("doc_id").cast("string"))
    planted = documents.select("doc_id", "text", hash_.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1))
    )
    g, n = F.expr("h div 10"), F.size("words").cast("long")
    placed = planted.withColumn("a", F.when(F.size("words") > 0, g % n)).withColumn(
        "p", F.expr("1 + (size(words) - a) div (3 + (h div 10) % 8)")
    )
    repeated = F.expr(
        "array_join(transform(sequence(0L, size(words) - 1L), i -> words[CAST(IF(i < a, i, a + (i - a) % p) AS INT)]), ' ')"
    )
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))
