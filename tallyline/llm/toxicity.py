"""Toxicity scores from a counterfactually regularised classifier.

A logistic model over the words of a document and their beginnings, so that inflected forms of a stem
count, and whether several words begin alike. Besides the usual loss it pays for every labelled sentence that names a group: the score of the
sentence must not change when the term is swapped for another of its list, neutral words included.
Every swapped sentence is built, and what counts are the features, of all levels, that it loses and gains.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``, the least by a hash of the
id) whose held-out flag is false; the score reads nothing but the text and every document is scored.

Defined results: a NULL text is empty; an empty or blank text has the score of the bias, like any text
without a known feature; contradicting labels of one id count as toxic, NULL labels not at all; of several texts of one id one is learned from;
without labelled rows every score is 0; without toxic or without clean ones the share of toxic ones;
repeated rows give repeated rows; empty input gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyline.llm.tables import written

SAMPLE_ROWS = 12_000
SELECTED_FEATURES = 4_096
# A feature is chosen if so many sampled documents have it and its shares among toxic and clean ones are so many
# standard errors apart: rarer ones are chance in a small sample.
LEAST_DOCUMENTS = 4
LEAST_DISTANCE = 5.0
RIDGE = 2e-4
SWAP_WEIGHT = 1.0
THRESHOLD = 0.7
HOLD_OUT = (3, 1)  # modulus and remainder
_BEGINNINGS = (3, 4, 5, 6)
# A feature holds at a level if that many distinct words have it.
LEVELS = (1, 2, 4)
_BUCKET_BITS = 24
_KEPT_WORDS = 300_000
_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"[.!?\n]+")

# Terms for groups of people, by list; the last of each list is neutral.
IDENTITY_LISTS = (
    ("women", "men", "girls", "boys", "people"),
    ("woman", "man", "girl", "boy", "person"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "believers"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "religious"),
    ("black", "white", "asian", "african", "latino", "european", "local"),
    ("gay", "lesbian", "bisexual", "transgender", "straight", "single"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("disabled", "deaf", "blind", "elderly", "young", "adult"),
    ("frauen", "männer", "mädchen", "jungen", "leute"),
    ("muslime", "christen", "juden", "hindus", "gläubige"),
    ("ausländer", "flüchtlinge", "einwanderer", "bürger"),
    ("femmes", "hommes", "filles", "garçons", "gens"),
    ("musulmans", "chrétiens", "juifs", "hindous", "croyants"),
    ("étrangers", "réfugiés", "immigrés", "citoyens"),
    ("mujeres", "hombres", "niñas", "niños", "gente"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "creyentes"),
    ("extranjeros", "refugiados", "inmigrantes", "ciudadanos"),
)
IDENTITY_TERMS = frozenset(term for terms in IDENTITY_LISTS for term in terms)


_SWAP = pa.struct([("gone", pa.list_(pa.int32())), ("come", pa.list_(pa.int32())), ("weight", pa.float64())])


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % HOLD_OUT[0] == HOLD_OUT[1]


def word_features(word: str) -> list[int]:
    """Hashes of a word and its beginnings."""
    names = [f"={word}"] + [word[:n] for n in _BEGINNINGS if len(word) >= n]
    return [xxhash.xxh32_intdigest(name.encode("utf-8", "surrogatepass")) >> (32 - _BUCKET_BITS) for name in names]


def text_features(words: set[str]) -> list[int]:
    """The features of all words with the levels they reach, as one number each."""
    counts = Counter(f for word in words for f in word_features(word))
    return sorted(f + (level << _BUCKET_BITS) for f, n in counts.items() for level, least in enumerate(LEVELS) if n >= least)


def swapped_features(sentence: set[str]) -> Iterator[tuple[list[int], list[int], float]]:
    """The features that a sentence loses and gains by each swap of an identity term, and the swap's weight: 1 for each term."""
    named = sentence & IDENTITY_TERMS
    if not named:
        return
    own = set(text_features(sentence))
    for group in IDENTITY_LISTS:
        for term in sorted(named.intersection(group)):
            for other in group:
                if other != term:
                    swapped = set(text_features(sentence - {term} | {other}))
                    yield sorted(own - swapped), sorted(swapped - own), 1 / (len(group) - 1)


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[int, float]  # by feature
    bias: float

    def scorer(self):
        """Scores of texts; words met before are kept with the known features they have."""
        known: dict[str, tuple[int, ...]] = {}
        weights, bias = self.weights, self.bias
        base = {f & ((1 << _BUCKET_BITS) - 1) for f in weights}

        def score(text: str | None) -> float:
            found: dict[int, int] = {}
            for word in words_of(text):
                own = known.get(word)
                if own is None:
                    if len(known) >= _KEPT_WORDS:
                        known.clear()
                    own = known[word] = tuple(f for f in word_features(word) if f in base)
                for f in own:
                    found[f] = found.get(f, 0) + 1
            total = bias
            for f in sorted(found):
                for level, least in enumerate(LEVELS):
                    if found[f] >= least:
                        total += weights.get(f + (level << _BUCKET_BITS), 0.0)
            return float(_sigmoid(total))

        return score


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


# --- training -------------------------------------------------------------------------------------


def _sample(documents: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``doc_id, toxic, text`` of the sampled labelled documents, one row for each id."""
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = (
        usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    chosen = F.broadcast(written(chosen, "toxicity-labels"))  # at most ``rows`` short rows
    return documents.select("doc_id", "text").join(chosen, "doc_id")


def _featurised(sample: DataFrame) -> DataFrame:
    """``doc_id, toxic, features`` and ``swaps``: what the sentences' swaps change, alike ones as one with the sum of their weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, swaps = [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                features.append(text_features(words))
                changes: Counter[tuple[tuple[int, ...], tuple[int, ...]]] = Counter()
                for sentence in [] if IDENTITY_TERMS.isdisjoint(words) else _SENTENCE.split(text.lower()):
                    for gone, come, weight in swapped_features(set(_WORD.findall(sentence))):
                        changes[tuple(gone), tuple(come)] += weight
                swaps.append([{"gone": gone, "come": come, "weight": weight} for (gone, come), weight in sorted(changes.items())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    batch.column("toxic"),
                    pa.array(features, pa.list_(pa.int32())),
                    pa.array(swaps, pa.list_(_SWAP)),
                ],
                ["doc_id", "toxic", "features", "swaps"],
            )

    swap = "struct<gone:array<int>,come:array<int>,weight:double>"
    found = sample.mapInArrow(run, f"doc_id long, toxic int, features array<int>, swaps array<{swap}>")
    # Different texts of one id: the same one on every run.
    single = found.groupBy("doc_id").agg(F.min(F.struct("toxic", "features", "swaps")).alias("row"))
    return written(single.select("doc_id", "row.*"), "toxicity-features")


def _selected(rows: DataFrame, toxic: int, clean: int, limit: int) -> list[int]:
    """The features whose shares among toxic and clean documents differ most, in standard errors."""
    counts = rows.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum("toxic").alias("bad"), F.count("toxic").alias("n")
    )
    share = F.col("n") / (toxic + clean)
    error = F.sqrt(share * (1 - share) * (1 / toxic + 1 / clean))
    distance = F.abs(F.col("bad") / toxic - (F.col("n") - F.col("bad")) / clean) / error
    likely = (F.col("n") >= LEAST_DOCUMENTS) & (share < 1) & (distance >= LEAST_DISTANCE)
    best = counts.filter(likely).orderBy(distance.desc(), "feature").limit(limit)
    return sorted(row.feature for row in best.collect())


def _fit(docs: list[list[int]], toxic: np.ndarray, swaps: list[tuple[list[int], list[int], float]], size: int) -> np.ndarray:
    """Weights and bias by Newton steps, each solved with conjugate gradients.

    The objective is the mean log loss, the ridge, and the mean squared score change over swaps.
    """
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    feature = np.array([f for d in docs for f in d], np.int64)
    swap_owner, swap_feature, swap_sign = [], [], []
    for i, (gone, come, weight) in enumerate(swaps):
        for fs, sign in ((gone, -1.0), (come, 1.0)):
            swap_owner += [i] * len(fs)
            swap_feature += fs
            swap_sign += [sign * np.sqrt(weight)] * len(fs)
    swap_owner, swap_feature = np.array(swap_owner, np.int64), np.array(swap_feature, np.int64)
    swap_sign = np.array(swap_sign, float)
    n = len(docs)

    def scores(w: np.ndarray) -> np.ndarray:
        return np.bincount(owner, w[feature], n) + w[size]

    def back(r: np.ndarray) -> np.ndarray:
        return np.r_[np.bincount(feature, r[owner], size), r.sum()]

    def swapped(w: np.ndarray) -> np.ndarray:
        change = np.bincount(swap_owner, w[swap_feature] * swap_sign, len(swaps) or 1)
        return np.r_[np.bincount(swap_feature, change[swap_owner] * swap_sign, size), 0.0]

    def smooth(w: np.ndarray) -> np.ndarray:
        return RIDGE * np.r_[w[:size], 0.0] + SWAP_WEIGHT * swapped(w)

    def loss(w: np.ndarray) -> float:
        z = scores(w)
        return float(np.mean(np.logaddexp(0, z) - toxic * z) + w @ smooth(w) / 2)

    w = np.zeros(size + 1)
    w[size] = np.log(toxic.mean() / (1 - toxic.mean()))
    now = loss(w)
    for _ in range(30):
        p = _sigmoid(scores(w))
        slope = back(p - toxic) / n + smooth(w)
        curve = p * (1 - p) / n + 1e-12
        step, rest = np.zeros_like(w), -slope
        way, square = rest.copy(), rest @ rest
        for _ in range(50):
            bent = back(curve * scores(way)) + smooth(way)
            length = square / (way @ bent)
            step += length * way
            rest -= length * bent
            fresh = rest @ rest
            if fresh < 1e-4 * (slope @ slope):
                break
            way, square = rest + fresh / square * way, fresh
        size_of_step = 1.0
        while (next_loss := loss(w + size_of_step * step)) > now and size_of_step > 1e-4:
            size_of_step /= 2
        if now - next_loss < 1e-9:
            break
        w, now = w + size_of_step * step, next_loss
    return w


def train(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Fits the model. Features are counted and chosen by Spark; the driver gets the chosen features of
    at most ``sample_rows`` documents.
    """
    rows = _featurised(_sample(documents, labels, sample_rows))
    total = rows.agg(F.count("toxic").alias("n"), F.sum("toxic").alias("bad")).first()
    toxic, clean = total["bad"] or 0, total["n"] - (total["bad"] or 0)
    if not toxic or not clean:
        return ToxicityModel({}, 500.0 if toxic else -500.0)
    chosen = _selected(rows, toxic, clean, SELECTED_FEATURES)
    wanted = F.array(*[F.lit(f) for f in chosen]).cast("array<int>")
    slim = rows.select("doc_id", "toxic", F.array_intersect("features", wanted).alias("features")).orderBy("doc_id").collect()
    place = {f: i for i, f in enumerate(chosen)}
    # Swaps that change the same chosen features are one; whole multiples of the weights add up alike in any order.
    sides = [F.sort_array(F.array_intersect(f"swap.{side}", wanted)).alias(side) for side in ("gone", "come")]
    every = rows.select(F.explode("swaps").alias("swap"))
    total = every.agg(F.sum(F.round(F.col("swap.weight"), 9).cast("decimal(28,9)"))).first()[0]
    alike = every.select(*sides, F.round(F.col("swap.weight"), 9).cast("decimal(28,9)").alias("weight"))
    alike = alike.filter("size(gone) + size(come) > 0").groupBy("gone", "come").agg(F.sum("weight").alias("weight")).orderBy("gone", "come")
    swaps = [([place[f] for f in r.gone], [place[f] for f in r.come], float(r.weight / total)) for r in alike.collect()]
    docs = [[place[f] for f in row.features] for row in slim]
    w = _fit(docs, np.array([row.toxic for row in slim], float), swaps, len(chosen))
    weights = {f: float(x) for f, x in zip(chosen, w)}
    return ToxicityModel(weights, float(w[-1]))


def _scores(documents: DataFrame, model: ToxicityModel, finish, schema: T.StructType) -> DataFrame:
    """``finish(batch, scores)`` of every Arrow batch of documents."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # at most SELECTED_FEATURES weights
    text_at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_of = shared.value.scorer()
        for batch in batches:
            yield finish(batch, np.array([score_of(text) for text in batch.column(text_at).to_pylist()], np.float64))

    return documents.mapInArrow(run, schema)


def score(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """``documents`` with a column ``score`` (another of that name is replaced): the model's probability of
    toxic for the whole text.
    """
    documents = documents.drop("score")
    schema = T.StructType([*documents.schema.fields, T.StructField("score", T.DoubleType())])

    def with_score(batch: pa.RecordBatch, scores: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, "score"])

    return _scores(documents, model, with_score, schema)


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` without those that score ``threshold`` or more, all columns kept."""
    keep = lambda batch, scores: batch.filter(pa.array(scores < threshold))
    return _scores(documents, train(documents, labels), keep, documents.schema)
