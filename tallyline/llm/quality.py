"""Quality scores from random-indexing word vectors and a small network.

Words are runs of letters and digits and runs of signs, case kept; a word that repeats the one before it counts as the word
*again*. Each falls by hash into one of ``2 ** BUCKET_BITS`` buckets. A bucket has a fixed random index vector with a few
entries of 1 and -1, and its word vector is the sum of the index vectors of the words up to ``WINDOW`` places beside its own, over
all documents: each task sums its part, and the parts are added in groups of a fixed size and then for each slice of the buckets.

A document is the mean of its words' vectors, once plain and once with frequent words weighted down. Two layers turn
it into a logit, which is divided by a temperature fitted on labelled rows that the weights were not fitted on, so that scores are
probabilities. The network learns from at most ``SAMPLE_ROWS`` labelled rows, the least by a hash of the id; every document is
scored, by its text alone.

Defined results: a NULL text is empty; empty and blank texts have the mean of no words, zero, and a score like any other;
contradicting labels of one id count as low quality, NULL labels not at all; of several texts of one id one is learned from;
without labelled rows every score is 0.5; with one label only it is that label; repeated rows give repeated rows; empty input gives
no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyline.llm.arrow_words import _word_hashes, blocks
from tallyline.llm.tables import written

SAMPLE_ROWS = 12_000
THRESHOLD = 0.3
HOLD_OUT = (5, 0)  # modulus and remainder
BUCKET_BITS = 13
DIMENSIONS = 64
NONZERO = 4
WINDOW = 2
HIDDEN = 24
# Words of this share of all words get half their weight.
COMMON = 1e-3
RIDGE = 2e-3
STEPS = 3_000
BATCH = 128
# One labelled row in so many fits the temperature.
CALIBRATE_ONE_IN = 5
_BUCKETS = 1 << BUCKET_BITS
_AGAIN = 0
# Words of a text that are pooled at once.
_POOLED_WORDS = 20_000
_SLICES = 64
# Partial sums that are added before the sums of a slice meet.
_GROUP = 256

# The bytes up to the space separate words; other bytes below 0x80 that are no letters or digits are signs.
_KIND = np.full(256, 1, np.uint8)
_KIND[:0x80] = 2
_KIND[:0x21] = 0
_KIND[[*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 1


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % HOLD_OUT[0] == HOLD_OUT[1]


def bucketed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every word, and the text that it is in."""
    texts = pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), "")])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    kind = _KIND[data]
    change = np.r_[True, kind[1:] != kind[:-1]][: len(data)]
    change[offsets[:-1][offsets[:-1] < len(data)]] = True
    begin = np.flatnonzero(change)
    size = np.diff(np.r_[begin, len(data)])
    is_word = kind[begin] > 0 if len(begin) else np.zeros(0, bool)
    start = begin[is_word]
    hashes = _word_hashes(data[kind > 0], size[is_word])
    owner = np.searchsorted(offsets, start, "right") - 1
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    again = np.r_[False, (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])][: len(bucket)]
    bucket[again] = _AGAIN
    return bucket, owner


def _index_entries() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of each bucket's index vector."""
    random = np.random.default_rng(20_240_501)
    places = np.argsort(random.random((_BUCKETS, DIMENSIONS)), axis=1)[:, :NONZERO]
    signs = np.where(np.arange(NONZERO) % 2 == 0, 1, -1)
    return places, signs


# --- word vectors ---------------------------------------------------------------------------------


def context_sums(bucket: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The sums of neighbours' index vectors for each bucket, and in the last column the number of its words."""
    places, signs = _index_entries()
    sums = np.zeros((_BUCKETS, DIMENSIONS + 1), np.int64)
    flat = np.zeros(_BUCKETS * DIMENSIONS, np.int64)
    for distance in range(1, WINDOW + 1):
        near = np.flatnonzero(owner[distance:] == owner[:-distance]) if len(owner) > distance else np.zeros(0, np.int64)
        left, right = bucket[near], bucket[near + distance]
        for k in range(NONZERO):
            met = np.r_[left * DIMENSIONS + places[right, k], right * DIMENSIONS + places[left, k]]
            flat += signs[k] * np.bincount(met, minlength=len(flat))
    sums[:, :DIMENSIONS] = flat.reshape(_BUCKETS, DIMENSIONS)
    sums[:, DIMENSIONS] = np.bincount(bucket, minlength=_BUCKETS)
    return sums


_PART = "part long, slice int, sums binary"


def _summed(parts: DataFrame) -> DataFrame:
    """One row for each slice and group of parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for part, slice_, sums in zip(*(batch.column(name).to_pylist() for name in ("part", "slice", "sums"))):
                key, own = (part // _GROUP, slice_), np.frombuffer(sums, np.int64)
                totals[key] = totals[key] + own if key in totals else own
        yield _part_rows([(*key, own) for key, own in sorted(totals.items())])

    # All parts of a key meet in one task, so each key has one row.
    return parts.repartition(F.col("slice"), F.expr(f"part div {_GROUP}")).mapInArrow(run, _PART)


def _part_rows(rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    columns = [
        pa.array([part for part, _, _ in rows], pa.int64()),
        pa.array([slice_ for _, slice_, _ in rows], pa.int32()),
        pa.array([sums.tobytes() for _, _, sums in rows], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["part", "slice", "sums"])


@dataclass(frozen=True)
class WordVectors:
    vectors: np.ndarray  # unit vectors by bucket
    weights: np.ndarray  # frequent words weighted down

    def pooled(self, bucket: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """One row for each text: the plain and the weighted mean of its words' vectors."""
        found = np.zeros((texts, 2, DIMENSIONS))
        shares = np.stack([np.ones(_BUCKETS, np.float32), self.weights])
        bounds = np.searchsorted(owner, np.arange(texts + 1))
        for text in np.flatnonzero(np.diff(bounds)).tolist():
            total = np.zeros((2, 1))
            for begin in range(bounds[text], bounds[text + 1], _POOLED_WORDS):
                own = bucket[begin : min(begin + _POOLED_WORDS, bounds[text + 1])]
                share = shares[:, own]
                found[text] += share @ self.vectors[own]
                total += share.sum(axis=1, keepdims=True, dtype=np.float64)
            found[text] /= total
        return found.reshape(texts, -1).astype(np.float32)


def word_vectors(documents: DataFrame) -> WordVectors:
    """Vectors of all buckets from all documents: counts and sums of whole numbers, the same on every run.

    The driver gets ``2 ** BUCKET_BITS`` vectors, whatever the volume.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((_BUCKETS, DIMENSIONS + 1), np.int64)
        for batch in batches:
            for _, texts in blocks(batch.column("text")):
                total += context_sums(*bucketed(texts))
        part = TaskContext.get().partitionId()
        yield _part_rows([(part, k, own) for k, own in enumerate(np.split(total, _SLICES)) if own.any()])

    parts = documents.select("text").mapInArrow(run, _PART)
    total = np.zeros((_SLICES, _BUCKETS // _SLICES * (DIMENSIONS + 1)), np.int64)
    # Groups of parts first, then everything; the rows of the second sum are at most one for each slice and _GROUP ** 2 parts.
    for batch in _summed(_summed(parts)).toArrow().to_batches():
        for slice_, sums in zip(batch.column("slice").to_pylist(), batch.column("sums").to_pylist()):
            total[slice_] += np.frombuffer(sums, np.int64)
    sums = total.reshape(_BUCKETS, DIMENSIONS + 1)
    vectors, counts = sums[:, :DIMENSIONS].astype(np.float64), sums[:, DIMENSIONS].astype(np.float64)
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    vectors /= np.where(lengths > 0, lengths, 1)[:, None]
    weights = COMMON / (COMMON + counts / max(counts.sum(), 1))
    return WordVectors(vectors.astype(np.float32), weights.astype(np.float32))


# --- network --------------------------------------------------------------------------------------


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass(frozen=True)
class Network:
    centre: np.ndarray
    spread: np.ndarray
    into: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float = 1.0

    def logits(self, rows: np.ndarray) -> np.ndarray:
        hidden = np.tanh((rows.astype(np.float64) - self.centre) / self.spread @ self.into + self.bias)
        return hidden @ self.out + self.out_bias

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(rows) / self.temperature)


def fit_network(rows: np.ndarray, good: np.ndarray) -> Network:
    """Two layers by Adam on the log loss, in a fixed order."""
    rows = rows.astype(np.float64)
    centre, spread = rows.mean(axis=0), rows.std(axis=0) + 1e-3
    x = (rows - centre) / spread
    random = np.random.default_rng(7)
    size = x.shape[1]
    share = min(max(good.mean(), 1e-3), 1 - 1e-3)
    p = [random.normal(0, size**-0.5, (size, HIDDEN)), np.zeros(HIDDEN), random.normal(0, HIDDEN**-0.5, HIDDEN), np.log(share / (1 - share))]
    first, second = [np.zeros_like(v) for v in p], [np.zeros_like(v) for v in p]
    step = 0
    while step < STEPS:
        order = random.permutation(len(x))
        for begin in range(0, len(x), BATCH):
            own = order[begin : begin + BATCH]
            rate = 3e-3 * max(1 - step / STEPS, 0.01)
            hidden = np.tanh(x[own] @ p[0] + p[1])
            error = (_sigmoid(hidden @ p[2] + p[3]) - good[own]) / len(own)
            back = error[:, None] * p[2] * (1 - hidden**2)
            slopes = [x[own].T @ back + RIDGE * p[0], back.sum(axis=0), hidden.T @ error + RIDGE * p[2], error.sum()]
            step += 1
            for k, slope in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope**2
                p[k] = p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Network(centre, spread, p[0], p[1], p[2], float(p[3]))


def fit_temperature(logits: np.ndarray, good: np.ndarray) -> float:
    """The temperature with the least log loss, between 1/4 and 16."""
    if not len(logits):
        return 1.0
    loss = lambda t: float(np.mean(np.logaddexp(0, logits / t) - good * logits / t))
    return min((2.0 ** (k / 8) for k in range(-16, 33)), key=loss)


@dataclass(frozen=True)
class QualityModel:
    words: WordVectors | None
    network: Network | None
    constant: float = 0.5  # without a network

    def scores(self, texts: pa.Array) -> np.ndarray:
        found = np.full(len(texts), self.constant)
        if self.network is not None:
            for first, own in blocks(texts):
                found[first : first + len(own)] = self.network.scores(self.words.pooled(*bucketed(own), len(own)))
        return found


def _sample(documents: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``doc_id, quality, text`` of the sampled labelled documents."""
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    chosen = F.broadcast(written(chosen, "quality-labels"))  # at most ``rows`` short rows
    return documents.select("doc_id", "text").join(chosen, "doc_id")


def _features(sample: DataFrame, words: WordVectors) -> DataFrame:
    """``doc_id, quality, features`` of the sample, one row for each id."""
    shared = sample.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in blocks(batch.column("text")):
                rows = shared.value.pooled(*bucketed(texts), len(texts))
                bounds = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(texts)).cast(pa.int64()),
                        batch.column("quality").slice(first, len(texts)),
                        pa.ListArray.from_arrays(bounds, pa.array(rows.reshape(-1))),
                    ],
                    ["doc_id", "quality", "features"],
                )

    found = sample.select("doc_id", "quality", "text").mapInArrow(run, "doc_id long, quality int, features array<float>")
    # Different texts of one id: the same one on every run.
    return found.groupBy("doc_id").agg(F.min(F.struct("quality", "features")).alias("row")).select("doc_id", "row.*")


def train(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Word vectors from all documents, and a network and its temperature from at most ``sample_rows`` labelled ones."""
    sample = _sample(documents, labels, sample_rows)
    words = word_vectors(documents)
    rows = _features(sample, words).toArrow().sort_by("doc_id")
    good = rows["quality"].to_numpy().astype(np.float64)
    if not len(good) or good.min() == good.max():
        return QualityModel(None, None, float(good[0]) if len(good) else 0.5)
    features = rows["features"].combine_chunks().flatten().to_numpy().reshape(len(good), -1)
    apart = np.arange(len(good)) % CALIBRATE_ONE_IN == 0
    if good[~apart].min() == good[~apart].max():
        apart[:] = False
    network = fit_network(features[~apart], good[~apart])
    temperature = fit_temperature(network.logits(features[apart]), good[apart])
    return QualityModel(words, Network(**{**network.__dict__, "temperature": temperature}))


def score(documents: DataFrame, model: QualityModel) -> DataFrame:
    """``documents`` with a column ``score`` (another of that name is replaced): the probability of good quality."""
    documents = documents.drop("score")
    shared = documents.sparkSession.sparkContext.broadcast(model)  # vectors of 2 ** BUCKET_BITS buckets
    text_at = documents.columns.index("text")
    schema = T.StructType([*documents.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(shared.value.scores(batch.column(text_at)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "score"])

    return documents.mapInArrow(run, schema)
