"""Order MinHash fingerprints: signatures that follow the edit distance of texts.

A text is the set of its k-mers of code points, each numbered by its occurrence, so that repetition
counts. Each of ``functions`` orders picks the ``length`` least of them and keeps these in the order of the text; the
hash of that tuple is one component. Two texts agree in a component if they share the picked k-mers in
the same order, so moved blocks and edits both cost likeness.

Defined results: a NULL text is empty; a text shorter than a k-mer is one k-mer itself, and an empty one has none, with a
fingerprint of its own that is like another empty one's in full; repeated rows give repeated rows;
empty input gives no rows; further columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

K = 8
FUNCTIONS = 64
LENGTH = 2
SEED = 20_240_607
# Ranges of ids for each shuffle partition: many, so that partitions are about equal.
_BUCKETS_PER_PARTITION = 16
_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed well-spread permutation of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


def kmer_hashes(points: np.ndarray, k: int = K) -> np.ndarray:
    """A 64-bit hash of every k-mer, by doubling the span of a polynomial hash."""
    if not len(points):
        return np.zeros(0, np.uint64)
    k = min(k, len(points))
    whole = _mixed(points.astype(np.uint64) + _GOLD)
    base, span, width = np.uint64(0x9DDFEA08EB382D69), whole, 1
    out, done = None, 0  # spans for the set bits of k, from the left
    with np.errstate(over="ignore"):
        while True:
            if k & width:
                size = len(points) - k + 1
                piece = span[done : done + size]
                out = piece.copy() if out is None else out * base + piece
                done += width
            if width * 2 > k:
                return _mixed(out)
            span = span[:-width] * base + span[width:]
            base, width = base * base + np.uint64(2), width * 2


def occurrences(hashes: np.ndarray) -> np.ndarray:
    """How many equal hashes stand before each one."""
    n = len(hashes)
    if n < 1 << 20:
        # Position in the low bits: an ordinary sort of numbers is stable and fast.
        key = np.sort((hashes & ~np.uint64((1 << 20) - 1)) | np.arange(n, dtype=np.uint64))
        order, value = (key & np.uint64((1 << 20) - 1)).astype(np.int64), key >> np.uint64(20)
    else:
        order = np.argsort(hashes, kind="stable")
        value = hashes[order]
    place = np.arange(n)
    first = np.maximum.accumulate(np.where(np.r_[True, value[1:] != value[:-1]], place, 0))
    found = np.empty(n, np.uint64)
    found[order] = (place - first).astype(np.uint64)
    return found


class OrderMinHash:
    def __init__(self, k: int = K, functions: int = FUNCTIONS, length: int = LENGTH, seed: int = SEED):
        random = np.random.default_rng(seed)
        self.k, self.length, self.functions = k, length, functions
        self.xor = random.integers(0, 2**32, functions, dtype=np.uint32)
        self.odd = random.integers(0, 2**31, functions, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

    def signature(self, points: np.ndarray) -> np.ndarray:
        """One 32-bit component for each order."""
        hashes = kmer_hashes(points, self.k)
        n = len(hashes)
        if not n:
            return np.zeros(self.functions, np.uint32)
        with np.errstate(over="ignore"):
            numbered = _mixed(hashes + occurrences(hashes) * _GOLD)
            small = (numbered >> np.uint64(32)).astype(np.uint32)
            length = min(self.length, n)
            picked = np.empty((self.functions, length), np.int64)
            for j in range(self.functions):
                # A product with an odd number permutes the hashes: its order is the j-th one.
                ranks = (small ^ self.xor[j]) * self.odd[j]
                for i in range(length):
                    at = int(ranks.argmin())
                    picked[j, i] = at
                    ranks[at] = 0xFFFFFFFF
            picked.sort(axis=1)  # back to the order of the text
            value = np.full(self.functions, length, np.uint64)
            for i in range(length):
                value = _mixed(value * _GOLD + numbered[picked[:, i]])
        return (value >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


# --- the next document ------------------------------------------------------------------------------


def _bucket(doc_id: Column, bounds: Column, steps: list[int], strict: bool) -> Column:
    """How many of the sorted bounds are at or below the id (below it, if strict), by halving steps."""

    def step(at: Column, width: Column) -> Column:
        bound = F.get(bounds, at + width - 1)
        inside = (bound < doc_id) if strict else (bound <= doc_id)
        return at + F.when(inside, width).otherwise(0)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def _numbers(values: list, kind: str) -> Column:
    """A constant array from one text: thousands of literals would take longer to send to the driver than the query."""
    if not values:
        return F.array().cast(f"array<{kind}>")
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def in_id_order(documents: DataFrame, buckets: int | None = None) -> DataFrame:
    """``bucket, role, doc_id, text``, sorted within partitions, each bucket with a follower of its last document.

    Buckets are ranges of ids between ids of the table, about as many documents in each. The first
    document of a bucket goes to the bucket before it as well (role 1), and the first of all to
    the last bucket (role 2): so whatever follows a document stands behind it, with one shuffle and
    no task that sees more than its range. NULL ids come last; equal ids are ordered by a hash of the text.
    """
    spark = documents.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = buckets or _BUCKETS_PER_PARTITION * partitions
    steps = [1 << i for i in reversed(range(max(1, (wanted - 1).bit_length())))]
    count = 2 * steps[0]
    shares = _numbers([i / count for i in range(1, count)], "double")
    stats = documents.agg(
        F.percentile_approx("doc_id", shares, 100 * count).alias("cuts"), F.min("doc_id").alias("first")
    ).first()
    bounds = _numbers(stats["cuts"] or [], "long")
    doc_id = F.col("doc_id")
    last = len(stats["cuts"] or [])
    own = F.when(doc_id.isNull(), last).otherwise(_bucket(doc_id, bounds, steps, strict=False))
    before = _bucket(doc_id, bounds, steps, strict=True)
    role = lambda bucket, number: F.struct(bucket.cast("int").alias("bucket"), F.lit(number).alias("role"))
    first_of_all = F.lit(stats["first"]).cast("long")
    roles = F.array(
        role(own, 0),
        F.when(before < own, role(before, 1)),
        F.when(doc_id.eqNullSafe(first_of_all), role(F.lit(last), 2)),
    )
    placed = documents.select(
        doc_id, F.col("text"), F.explode(F.filter(roles, lambda r: r.isNotNull())).alias("r")
    ).select("r.bucket", "r.role", "doc_id", "text")
    return (
        placed.repartition(partitions, "bucket")
        .sortWithinPartitions("bucket", "role", F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    )


def fingerprints(
    documents: DataFrame, k: int = K, functions: int = FUNCTIONS, length: int = LENGTH, buckets: int | None = None
) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every document.

    The edited text is the text with its last half replaced by as much of the next document's beginning.
    Fingerprints are hexadecimal, eight digits a component.
    """
    fields = [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
    schema = T.StructType(fields)
    arrow = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64())]
        + [(f.name, pa.string()) for f in fields[2:5]]
        + [(f.name, pa.float64()) for f in fields[5:]]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = OrderMinHash(k, functions, length)
        waiting = None
        for batch in batches:
            rows = []
            for bucket, role, doc_id, text in zip(*(column.to_pylist() for column in batch.columns)):
                text = text or ""
                if role and waiting is None:
                    continue
                own = sketch.signature(code_points(text))
                if waiting is not None and waiting[0] == bucket:
                    rows.append(_row(sketch, *waiting[1:], text, own))
                waiting = (bucket, doc_id, text, own) if role == 0 else None
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), arrow)], schema=arrow)

    return in_id_order(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), buckets).mapInArrow(run, schema)


def edited_text(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _row(sketch: OrderMinHash, doc_id: int | None, text: str, own: np.ndarray, following: str, other: np.ndarray) -> tuple:
    edited = edited_text(text, following)
    changed = sketch.signature(code_points(edited))
    return (
        doc_id,
        len(text),
        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        own.astype(">u4").tobytes().hex(),
        changed.astype(">u4").tobytes().hex(),
        likeness(own, changed),
        likeness(own, other),
    )
