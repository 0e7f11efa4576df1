"""SimHash near-duplicates over a hierarchical index of fingerprints in Gray order.

Documents become 64-bit fingerprints, documents with one fingerprint become one entry. Two entries that
differ in at most ``max_bits`` bits agree in full on one of ``max_bits + 1`` blocks of bits, so the
upper nodes of the index are masked patterns: an entry stands under each block's mask and its bits
there. A pattern that too many entries share gets longer: its free bits are divided into blocks in the
same way, so no node ever holds more than a fixed number of entries, whatever the data.

Below a node the entries stand in the order of their Gray rank, in which neighbours differ in few
bits. Runs of neighbours form a tree whose nodes keep the bits that all their entries share; two nodes
whose shared bits differ in more than ``max_bits`` places are pruned with everything below. What is
left is compared in full, so the links are exact. A task hands on one edge per linked entry, not all pairs.

Defined results: a NULL, empty or blank text has fingerprint zero and is linked like any other; NULL
ids take part, but never name a component that has another id; repeated rows fall into one entry;
empty input gives no rows; further columns are ignored by :func:`near_groups` and kept by :func:`drop_near_copies`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyline.llm.components import connected_components
from tallyline.llm.tables import written

BITS = 64
SHINGLE_WORDS = 3
MAX_BITS = 2
# Entries under one pattern; with this few free bits a pattern can't have more.
NODE_ENTRIES = 4096
_FANOUT = 16
_BLOCK = 1 << 19
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


# --- fingerprints ---------------------------------------------------------------------------------


def _hashes(text: str | None, words: int, seed: int) -> Iterator[np.ndarray]:
    """The hashes of all shingles of a text, in blocks."""
    parts = (text or "").encode().translate(_LOWER).split()
    if not parts:
        return
    line = b" ".join(parts)
    if len(parts) <= words:
        yield np.array([xxhash.xxh64_intdigest(line, seed)], np.uint64)
        return
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    starts, ends = starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _BLOCK):
        block = [digest(line[a:b], seed) for a, b in zip(starts[at : at + _BLOCK], ends[at : at + _BLOCK])]
        yield np.array(block, np.uint64)


def _majority(blocks: list[np.ndarray], sizes: list[int]) -> np.ndarray:
    """A fingerprint for each run of ``sizes`` hashes: the bits set in over half of them."""
    found = np.zeros(len(sizes), np.uint64)
    counts = np.array(sizes, np.int64)
    filled = np.flatnonzero(counts)
    if len(filled):
        bits = np.unpackbits(np.concatenate(blocks).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        offsets = np.concatenate([[0], np.cumsum(counts[filled])[:-1]])
        ones = np.add.reduceat(bits, offsets, axis=0, dtype=np.int32)
        over = (2 * ones > counts[filled, None]).astype(np.uint8)
        found[filled] = np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()
    return found


def simhash(texts: list[str | None], words: int = SHINGLE_WORDS, seed: int = 42) -> np.ndarray:
    """Fingerprints of texts. Long ones are counted block by block; short ones share a block."""
    out: list[np.ndarray] = []
    blocks: list[np.ndarray] = []
    sizes: list[int] = []

    def flush() -> None:
        if sizes:
            out.append(_majority(blocks, sizes))
            blocks.clear()
            sizes.clear()

    for text in texts:
        own = []
        ones, total = None, 0
        for block in _hashes(text, words, seed):
            if len(block) < _BLOCK and ones is None:
                own.append(block)
            else:
                bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones = bits.sum(axis=0, dtype=np.int64) + (0 if ones is None else ones)
                total += len(block)
        if ones is not None:
            flush()
            out.append(np.packbits((2 * ones > total).astype(np.uint8), bitorder="little").view(np.uint64))
            continue
        blocks.extend(own)
        sizes.append(sum(map(len, own)))
        if sum(sizes) > _BLOCK // 4:
            flush()
    flush()
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def fingerprints(documents: DataFrame, words: int = SHINGLE_WORDS, seed: int = 42) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, fp`` (the 64 bits as a long) and ``text_hash``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = simhash(batch.column(1).to_pylist(), words, seed)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64)), batch.column(2)], ["doc_id", "fp", "text_hash"]
            )

    slim = documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    fields = [documents.schema["doc_id"], T.StructField("fp", T.LongType()), T.StructField("text_hash", T.LongType())]
    return slim.mapInArrow(run, T.StructType(fields))


def fingerprint_text(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# --- index ----------------------------------------------------------------------------------------


def _blocks(free: int, parts: int) -> list[int]:
    """The set bits of ``free`` in ``parts`` masks of about equal width."""
    places = [i for i in range(BITS) if free >> i & 1]
    return [sum(1 << i for i in piece.tolist()) for piece in np.array_split(np.array(places, int), parts)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def gray_rank(fp: Column) -> Column:
    """The place of a bit pattern in the reflected Gray code."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def _tree(values: np.ndarray, groups: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Levels from the entries up to one node per group: shared bits, pattern, first and last child."""
    levels = [(np.full(len(values), np.uint64(2**64 - 1)), values, None, None)]
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    while len(starts) < len(levels[-1][1]):
        shared, pattern = levels[-1][:2]
        sizes = np.diff(np.r_[starts, len(pattern)])
        inside = np.arange(len(pattern)) - np.repeat(starts, sizes)
        first = np.flatnonzero(inside % _FANOUT == 0)
        owner = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(pattern)]))
        differing = np.bitwise_or.reduceat(pattern ^ pattern[first][owner], first)
        common = np.bitwise_and.reduceat(shared, first) & ~differing
        levels.append((common, pattern[first] & common, first, np.r_[first[1:], len(pattern)]))
        starts = np.r_[0, np.cumsum(-(-sizes // _FANOUT))[:-1]]
    return levels


def _links(values: np.ndarray, groups: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of index pairs of one group that differ in at most ``max_bits`` bits: the tree, from the top."""
    levels = _tree(values, groups)
    top = np.arange(len(levels[-1][1]))
    stack = [(len(levels) - 1, top, top)]
    while stack:
        level, a, b = stack.pop()
        if level == 0:
            if len(a):
                yield a, b
            continue
        first, last = levels[level][2:]
        wide_a, wide_b = last[a] - first[a], last[b] - first[b]
        many = wide_a * wide_b
        if many.sum() > _BLOCK and len(a) > 1:
            half = len(a) // 2
            stack += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
            continue
        owner = np.repeat(np.arange(len(a)), many)
        inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        left = first[a][owner] + inside // wide_b[owner]
        right = first[b][owner] + inside % wide_b[owner]
        once = left < right if level == 1 else left <= right
        shared, pattern = levels[level - 1][:2]
        left, right = left[once], right[once]
        apart = np.bitwise_count((pattern[left] ^ pattern[right]) & shared[left] & shared[right])
        near = apart <= max_bits
        stack.append((level - 1, left[near], right[near]))


def _roots(size: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least index that each index is linked to, over any number of links."""
    label = np.arange(size)
    for a, b in links:
        while True:
            la, lb = label[a], label[b]
            apart = la != lb
            if not apart.any():
                break
            low, high = np.minimum(la, lb)[apart], np.maximum(la, lb)[apart]
            np.minimum.at(label, high, low)
            while (label[label] != label).any():
                label = label[label]
    return label


def _search(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Edges to the least linked entry of every node, for entries sorted by node and Gray rank."""
    rest = [np.zeros(0, np.int64)] * 3
    last = False
    source = iter(batches)
    while not last:
        batch = next(source, None)
        last = batch is None
        if not last:
            rest = [np.concatenate([old, batch.column(i).to_numpy()]) for i, old in enumerate(rest)]
        mask, pattern, fp = rest
        if not len(fp):
            continue
        new = np.r_[True, (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])]
        starts = np.flatnonzero(new)
        end = len(fp) if last else starts[-1]  # the last node may go on in the next batch
        rest = [column[end:] for column in rest]
        group = np.cumsum(new)[:end]
        sizes = np.bincount(group)
        shared = sizes[group] > 1
        values, group = fp[:end][shared].view(np.uint64), group[shared]
        if not len(values):
            continue
        root = _roots(len(values), _links(values, group, max_bits))
        moved = np.flatnonzero(root != np.arange(len(root)))
        signed = values.view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[root[moved]])], ["a", "b"])


def near_links(entries: DataFrame, max_bits: int = MAX_BITS, node_entries: int = NODE_ENTRIES) -> DataFrame:
    """Distinct ``fp`` -> edges ``a, b`` that connect all entries within ``max_bits`` of each other."""
    spark = entries.sparkSession
    masks = _blocks(2**BITS - 1, max_bits + 1)
    standing = entries.select("fp", F.explode(F.array(*[F.lit(_signed(m)).cast("long") for m in masks])).alias("mask"))
    edges = None
    while True:
        standing = written(standing.withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask"))), "gray-nodes")
        sizes = standing.groupBy("mask", "pattern").agg(F.count("fp").alias("n"))
        crowded = written(sizes.filter(F.col("n") > node_entries).select("mask", "pattern"), "gray-crowded")
        done = crowded.isEmpty()
        fitting = standing if done else standing.join(crowded, ["mask", "pattern"], "left_anti")
        sorted_nodes = (
            fitting.repartition("mask", "pattern")
            .sortWithinPartitions("mask", "pattern", gray_rank(F.col("fp")))
            .select("mask", "pattern", "fp")
        )
        found = sorted_nodes.mapInArrow(lambda batches: _search(batches, max_bits), "a long, b long")
        edges = found if edges is None else edges.unionByName(found)
        if done:
            return edges
        # Longer patterns for the crowded nodes: at most (max_bits + 1) ** depth masks.
        masks = [m for m in masks]
        children = [(_signed(m), _signed(m | more)) for m in masks for more in _blocks(~m & (2**BITS - 1), max_bits + 1)]
        masks = [child & (2**BITS - 1) for _, child in children]
        longer = spark.createDataFrame(children, "mask long, child long")
        standing = (
            standing.join(crowded, ["mask", "pattern"], "left_semi")
            .join(F.broadcast(longer), "mask")
            .select("fp", F.col("child").alias("mask"))
            .distinct()
        )


def near_groups(
    documents: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, node_entries: int = NODE_ENTRIES
) -> DataFrame:
    """``doc_id, fp, text_hash, root, component_id`` of every document.

    ``root`` is the group's own name (a fingerprint), ``component_id`` the least id in it.
    """
    prints = written(fingerprints(documents, words), "simhash")
    entries = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-entries")
    roots = written(connected_components(near_links(entries, max_bits, node_entries), "simhash"), "simhash-roots")
    entries = written(
        entries.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")),
        "simhash-rooted",
    )
    groups = written(entries.groupBy("root").agg(F.min("least_id").alias("component_id")), "simhash-groups")
    named = written(entries.select("fp", "root").join(groups, "root"), "simhash-named")
    return prints.join(named, "fp").select("doc_id", "fp", "text_hash", "root", "component_id")


def drop_near_copies(documents: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``documents`` with one document of each near-duplicate group: the one with the least id (NULL last).

    Rows that agree in id and text are one document; one of them stays.
    """
    grouped = written(near_groups(documents, words, max_bits), "near-groups")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    first = written(grouped.groupBy("root").agg(F.min(order).alias("first")), "near-first")
    flagged = grouped.join(first, "root").withColumn("stays", order.eqNullSafe(F.col("first")))
    key = [F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash")]
    dropped = written(flagged.filter(~F.col("stays")).select(*key).distinct(), "near-dropped")
    repeated = written(
        flagged.filter("stays").groupBy("doc_id", "text_hash").count().filter("count > 1").select(*key), "near-repeated"
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.xxhash64("text") == F.col("_text_hash"))
    kept = documents.join(dropped, same, "left_anti")
    if repeated.isEmpty():
        return kept
    single = kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, same, "left_anti").unionByName(single)
