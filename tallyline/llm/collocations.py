"""Phrases whose words belong together, mined after Toivonen.

A phrase is two to ``LONGEST`` words that follow one another inside a piece of a text. Frequent phrases are found in three steps:

1. A sample, one document in ``SAMPLE_ONE_IN`` by a hash of id and text, proposes phrases: level by level, those that it holds
   ``lowered()`` times, from phrases whose own parts are proposed.
2. One pass over all documents counts the proposed phrases and their negative border exactly: every phrase both of whose
   parts (all words but the last, all but the first) are proposed. All single words are counted.
3. A border phrase that turns out frequent is a failure of the sample: longer phrases around it have not been counted. A further
   pass counts every phrase that was not and may be frequent, since each part is either known to be or not counted itself. It
   repeats until no failure is left to expand; by that rule one pass is enough.

The counts are exact whatever the sample proposes. Proposed and frequent phrases are known to the passes by filters of hash bits with
a fixed limit (``FILTER_BITS``): a false positive, more of them beyond the limit, makes a pass count more phrases and changes no result.
Phrases are counted inside blocks of text first, then by Spark's grouped sums; nothing else of a text is shuffled.

Defined results: a NULL text is empty; a NULL language is ``und``; repeated rows count each time; empty input gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tallyline.llm.arrow_words import _word_hashes, blocks, mixed
from tallyline.llm.tables import written

LEAST_COUNT = 30
LONGEST = 4
TOP = 2_000
# A phrase is dropped if a longer one around it has this share of its occurrences.
ABSORBED_PERCENT = 80
SCALE = 2_000_000
UNKNOWN_LANG = "und"
SAMPLE_ONE_IN = 8
# Bits of a filter: 16 for each phrase, at most 32 MB.
FILTER_BITS = 1 << 28
BLOCK_BYTES = 1_000_000
_EMITTED_ROWS = 50_000
_SALTS = 64
_BASE = np.uint64(0x9DDFEA08EB382D69)
_SPACE = pa.scalar(" ", pa.large_string())

# Bytes that separate words, and bytes that separate pieces.
_WORD_END = np.zeros(256, bool)
_WORD_END[[0x20, 0x09]] = True
_PIECE_END = np.zeros(256, bool)
_PIECE_END[list(b".,;:!?\n\x0b\x0c\r")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(least: int, one_in: int) -> int:
    """The count in a sample that proposes a phrase: one standard deviation below the expected, at least 2."""
    expected = least / one_in
    return max(2, int(expected - expected**0.5))


# --- phrases of a block ---------------------------------------------------------------------------


@dataclass
class Level:
    """The distinct phrases of one length in a block of texts, by number."""

    name: np.ndarray  # number of the phrase at each word, or -1
    count: np.ndarray
    lang: np.ndarray  # code of the language
    hash: np.ndarray
    text: pa.Array
    prefix: np.ndarray  # number of all words but the last in the level before
    suffix: np.ndarray


@dataclass
class Block:
    """Words of a run of texts, and which words are in one piece."""

    langs: pa.Array  # languages by code
    follows: np.ndarray  # the next word is in the same piece
    words: Level


def read_block(texts: pa.Array, langs: pa.Array) -> Block:
    texts = pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), "")])
    langs = pc.fill_null(langs.cast(pa.large_string()), UNKNOWN_LANG).dictionary_encode()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    data, offsets = _LOWER[data], offsets - offsets[0]
    starts = np.zeros(len(data) + 1, bool)
    starts[offsets] = True
    breaks = _PIECE_END[data]
    inside = ~(_WORD_END[data] | breaks)
    start = np.flatnonzero(inside & (starts[:-1] | np.r_[True, ~inside[:-1]][: len(data)]))
    end = np.flatnonzero(inside & (starts[1:] | np.r_[~inside[1:], True][: len(data)])) + 1
    piece = np.cumsum(breaks | starts[:-1], dtype=np.int64)[start]
    lang_of_text = langs.indices.to_numpy()
    lang = lang_of_text[np.searchsorted(offsets, start, "right") - 1]
    letters = np.ascontiguousarray(data[inside])
    bounds = np.r_[0, np.cumsum(end - start)]
    column = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(bounds), pa.py_buffer(letters))
    coded = column.dictionary_encode()
    vocabulary = coded.dictionary
    key = lang.astype(np.int64) * max(len(vocabulary), 1) + coded.indices.to_numpy()
    distinct, name, count = np.unique(key, return_inverse=True, return_counts=True)
    code, word = np.divmod(distinct, max(len(vocabulary), 1))
    words = Level(
        name.reshape(-1), count, code, _mixed_hashes(langs.dictionary)[code] * _BASE + _mixed_hashes(vocabulary)[word],
        vocabulary.take(pa.array(word)), word, word,
    )
    words.hash = mixed(words.hash + np.uint64(1))
    return Block(langs.dictionary, np.r_[piece[1:] == piece[:-1], False][: len(start)], words)


def _mixed_hashes(texts: pa.Array) -> np.ndarray:
    """64 bits of each text's bytes."""
    texts = pa.concat_arrays([texts.cast(pa.large_string())])
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw is not None else np.zeros(0, np.uint8)
    size, found = np.diff(bounds), np.zeros(len(texts), np.uint64)
    found[size > 0] = _word_hashes(data, size[size > 0])
    return found


def _longer_hash(prefix: np.ndarray, last: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(prefix * _BASE + last + np.uint64(2))


def longer(block: Block, level: Level, goes_on: np.ndarray, words: int) -> Level:
    """The phrases of ``words`` words both of whose parts go on."""
    at = np.append(level.name, -1)
    ok = np.append(goes_on, False)[at]
    place = np.flatnonzero(ok[:-1] & ok[1:] & block.follows)
    size = len(level.count)
    key = at[place] * size + at[place + 1]
    distinct, number, count = np.unique(key, return_inverse=True, return_counts=True)
    prefix, suffix = np.divmod(distinct, max(size, 1))
    first = np.zeros(len(distinct), np.int64)
    first[number.reshape(-1)] = place
    last = block.words.name[first + words - 1]
    name = np.full(len(level.name), -1, np.int64)
    name[place] = number.reshape(-1)
    text = pc.binary_join_element_wise(level.text.take(pa.array(prefix)), block.words.text.take(pa.array(last)), _SPACE)
    return Level(name, count, level.lang[prefix], _longer_hash(level.hash[prefix], block.words.hash[last]), text, prefix, suffix)


# --- filters --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class PhraseFilter:
    """Two hash bits of every phrase of a set."""

    bits: np.ndarray

    def places(self, hashes: np.ndarray) -> list[np.ndarray]:
        mask = np.uint64(len(self.bits) * 64 - 1)
        return [hashes & mask, (hashes >> np.uint64(32)) & mask]

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in self.places(hashes):
            found &= (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return found


def phrase_hashes(langs: pa.Array, phrases: pa.Array) -> np.ndarray:
    """The hashes that :func:`longer` gives the phrases."""
    lists = pc.split_pattern(phrases.cast(pa.large_string()), " ")
    flat = _mixed_hashes(lists.flatten())
    sizes = np.diff(lists.offsets.to_numpy())
    own = np.repeat(_mixed_hashes(langs), sizes)
    with np.errstate(over="ignore"):
        word = mixed(own * _BASE + flat + np.uint64(1))
    begin = np.cumsum(sizes) - sizes
    total = word[begin] if len(begin) else word
    for k in range(1, int(sizes.max(initial=0))):
        longer_ones = np.flatnonzero(sizes > k)
        total[longer_ones] = _longer_hash(total[longer_ones], word[begin[longer_ones] + k])
    return total


def phrase_filter(phrases: DataFrame) -> PhraseFilter:
    """The filter of the phrases ``lang, phrase``; its bits are set by Spark and reach the driver as at most 32 MB."""
    wanted, size = 16 * phrases.count(), 1 << 10
    while size < wanted and size < FILTER_BITS:
        size *= 2
    empty = PhraseFilter(np.zeros(size // 64, np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The bits alone are used there, and only their number.
        shape = PhraseFilter(np.broadcast_to(np.uint64(0), size // 64))
        for batch in batches:
            place = np.concatenate(shape.places(phrase_hashes(batch.column("lang"), batch.column("phrase"))))
            bit = (np.uint64(1) << (place & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((place >> np.uint64(6)).astype(np.int32)), pa.array(bit)], ["slot", "bits"])

    slots = phrases.select("lang", "phrase").mapInArrow(run, "slot int, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    empty.bits[slots["slot"].to_numpy()] = slots["bits"].to_numpy().view(np.uint64)
    return empty


# --- passes ---------------------------------------------------------------------------------------

# Given the levels of a block, (level, phrases to count) of those to count.
Rule = Callable[[Block], Iterator[tuple[Level, np.ndarray]]]


def _propose(proposed: list[PhraseFilter]) -> Rule:
    """The phrases one word longer than those proposed."""

    def rule(block: Block) -> Iterator[tuple[Level, np.ndarray]]:
        level = block.words
        for words, known in enumerate(proposed, 2):
            level = longer(block, level, known.holds(level.hash), words)
        yield level, np.ones(len(level.count), bool)

    return rule


def _with_border(proposed: list[PhraseFilter], longest: int) -> Rule:
    """All words, proposed phrases and their negative border."""

    def rule(block: Block) -> Iterator[tuple[Level, np.ndarray]]:
        level = block.words
        yield level, np.ones(len(level.count), bool)
        for words, known in zip(range(2, longest + 1), proposed):
            level = longer(block, level, known.holds(level.hash), words)
            yield level, np.ones(len(level.count), bool)

    return rule


def _expand(proposed: list[PhraseFilter], frequent: list[PhraseFilter], longest: int) -> Rule:
    """What :func:`_with_border` does not count and may be frequent."""

    def rule(block: Block) -> Iterator[tuple[Level, np.ndarray]]:
        level = block.words
        counted = np.ones(len(level.count), bool)
        for words, known, sure in zip(range(2, longest + 1), proposed, frequent):
            went_on = counted & known.holds(level.hash)
            level = longer(block, level, ~counted | sure.holds(level.hash), words)
            counted = went_on[level.prefix] & went_on[level.suffix]
            yield level, ~counted

    return rule


def _counts(documents: DataFrame, rule: Rule) -> DataFrame:
    """``lang, phrase, f`` of the phrases that the rule counts; the row without a phrase counts all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in blocks(batch.column("text"), BLOCK_BYTES):
                block = read_block(texts, batch.column("lang").slice(first, len(texts)))
                total = np.bincount(block.words.lang, block.words.count, len(block.langs)).astype(np.int64)
                yield emitted_rows(block.langs, pa.nulls(len(total), pa.large_string()), total)
                for level, chosen in rule(block):
                    at = np.flatnonzero(chosen)
                    for own in np.split(at, range(_EMITTED_ROWS, len(at), _EMITTED_ROWS)):
                        places = pa.array(own)
                        yield emitted_rows(block.langs.take(pa.array(level.lang[own])), level.text.take(places), level.count[own])

    def emitted_rows(langs: pa.Array, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        columns = [langs.cast(pa.string()), phrases.cast(pa.string()), pa.array(counts, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "n"])

    emitted = documents.select("text", "lang").mapInArrow(run, "lang string, phrase string, n long")
    return emitted.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def _of_length(phrases: DataFrame, words: int) -> DataFrame:
    return phrases.filter(F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit(""))) == words - 1)


def _failures(frequent: DataFrame, proposed: list[PhraseFilter]) -> DataFrame:
    """Frequent phrases that were not proposed and may be part of longer ones."""
    shared = frequent.sparkSession.sparkContext.broadcast(proposed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases = batch.column("phrase")
            hashes = phrase_hashes(batch.column("lang"), phrases)
            words = pc.count_substring(phrases, " ").to_numpy(zero_copy_only=False)
            known = np.zeros(len(hashes), bool)
            for k, own in enumerate(shared.value):
                known |= (words == k) & own.holds(hashes)
            yield batch.filter(pa.array(~known & (words < len(shared.value))))

    return frequent.select("lang", "phrase").mapInArrow(run, "lang string, phrase string")


def frequent_phrases(
    documents: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST, one_in: int = SAMPLE_ONE_IN
) -> DataFrame:
    """``lang, phrase, f`` of every phrase of 1 to ``longest`` words with at least ``least`` occurrences.

    The row of a language without a phrase counts its words. The table is written.
    """
    context = documents.sparkSession.sparkContext
    # Copies of a text are chosen each on its own, if they have ids.
    chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(one_in)) == 0
    sample = written(documents.filter(chosen).select("text", "lang"), "phrases-sample")
    proposed: list[PhraseFilter] = []
    for _ in range(1, longest):
        shared = context.broadcast(list(proposed))
        level = _counts(sample, lambda block, shared=shared: _propose(shared.value)(block))
        enough = level.filter(F.col("phrase").isNotNull() & (F.col("f") >= lowered(least, one_in)))
        proposed.append(phrase_filter(written(enough, "phrases-proposed")))
        shared.unpersist()

    def frequent_of(counts: DataFrame) -> DataFrame:
        return written(counts.filter(F.col("phrase").isNull() | (F.col("f") >= least)), "phrases-frequent")

    shared = context.broadcast(proposed)
    frequent = frequent_of(_counts(documents, lambda block: _with_border(shared.value, longest)(block)))
    phrases = frequent.dropna(subset=["phrase"])
    if _failures(phrases, proposed).isEmpty():
        return frequent
    sure = [phrase_filter(_of_length(phrases, words)) for words in range(1, longest)]
    both = context.broadcast((proposed, sure))
    # It counts all that may be frequent and was not counted: no failure can be left.
    more = frequent_of(_counts(documents, lambda block: _expand(*both.value, longest)(block)).dropna(subset=["phrase"]))
    return frequent.unionByName(more)


# --- collocations ---------------------------------------------------------------------------------


def collocations(
    documents: DataFrame,
    least: int = LEAST_COUNT,
    longest: int = LONGEST,
    top: int = TOP,
    one_in: int = SAMPLE_ONE_IN,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language.

    A phrase's score is the least of its cuts': ``floor(SCALE * a / (l + r))`` of its count a and those of the parts. Phrases
    inside a longer one with ``ABSORBED_PERCENT`` of their occurrences are dropped.
    """
    return score_phrases(frequent_phrases(documents, least, longest, one_in), top)


def score_phrases(counts: DataFrame, top: int = TOP) -> DataFrame:
    """The collocations among the phrases of :func:`frequent_phrases`."""
    words = F.split("phrase", " ")
    known = counts.dropna(subset=["phrase"])
    candidates = known.withColumn("w", words).filter(F.size("w") >= 2)
    cuts = candidates.select("lang", "phrase", "f", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("cut"))
    text = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    cuts = cuts.select(
        "lang", "phrase", "f", "cut", text(F.lit(1), F.col("cut")).alias("first"), text(F.col("cut") + 1, F.size("w") - F.col("cut")).alias("rest")
    )
    left = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    # Decimals: the product may pass 64 bits.
    score = F.expr(f"CAST(CAST({SCALE} AS DECIMAL(10,0)) * CAST(f AS DECIMAL(20,0)) div (CAST(l AS DECIMAL(20,0)) + r) AS BIGINT)")
    scored = (
        cuts.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("a"), F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))
    )
    inner = candidates.filter(F.size("w") >= 3).select(
        "lang",
        "f",
        F.explode(
            F.expr(
                "flatten(transform(sequence(2, size(w) - 1), k -> transform(sequence(1, size(w) - k + 1), i -> array_join(slice(w, i, k), ' '))))"
            )
        ).alias("phrase"),
    )
    around = inner.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    absorbed = F.col("around").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * ABSORBED_PERCENT
    kept = scored.join(around, ["lang", "phrase"], "left").filter(~F.coalesce(absorbed, F.lit(False)))
    order = [F.col("best.score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # A language's first rows are among the first rows of its salts: no task sorts a whole language.
    by_salt = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))).orderBy(*order)
    short = kept.withColumn("place", F.row_number().over(by_salt)).filter(F.col("place") <= top)
    ranked = short.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    n = counts.filter(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))
    return ranked.join(n, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score"
    )


def oracle(least: int = LEAST_COUNT, top: int = TOP) -> str:
    """The collocations in DuckDB's SQL."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, '{UNKNOWN_LANG}') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
tokens AS (SELECT lang, list_filter(string_split(replace(piece, chr(9), ' '), ' '), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, unnest(flatten(list_transform([1, 2, 3, 4],
         lambda k: list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))))) AS phrase
  FROM tokens),
counts AS (
  SELECT lang, phrase, f, string_split(phrase, ' ') AS p, len(string_split(phrase, ' ')) AS k
  FROM (SELECT lang, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {least})),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM tokens GROUP BY lang),
parts AS (
  SELECT c.lang, c.phrase, c.f AS a, s.cut,
         array_to_string(c.p[1 : s.cut], ' ') AS first, array_to_string(c.p[s.cut + 1 : c.k], ' ') AS rest
  FROM counts c, (SELECT unnest([1, 2, 3]) AS cut) s WHERE s.cut < c.k),
cuts AS (
  SELECT d.lang, d.phrase, d.a, d.cut, l.f AS l, r.f AS r, ({SCALE}::HUGEINT * d.a) // (l.f + r.f) AS score
  FROM parts d JOIN counts l ON l.lang = d.lang AND l.phrase = d.first JOIN counts r ON r.lang = d.lang AND r.phrase = d.rest),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_ AS (
  SELECT c.lang, c.f, array_to_string(c.p[t.i : t.i + s.k - 1], ' ') AS phrase
  FROM counts c, (SELECT unnest([2, 3]) AS k) s, (SELECT unnest([1, 2, 3]) AS i) t WHERE s.k < c.k AND t.i + s.k - 1 <= c.k),
around AS (SELECT lang, phrase, max(f) AS f FROM inner_ GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN around o ON b.lang = o.lang AND b.phrase = o.phrase
  WHERE o.f IS NULL OR 100::HUGEINT * o.f < {ABSORBED_PERCENT}::HUGEINT * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= {top}"""
