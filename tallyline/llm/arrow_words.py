"""Words of Arrow string columns as numpy arrays: hashes, places and lines, without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_GOLD, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9DDFEA08EB382D69)
# The bytes that separate words are a space and 0x09 to 0x0D.
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# Bytes of text that are worked on at once; a longer text is one block.
BLOCK_BYTES = 2_000_000
_CHUNK_BYTES = 1 << 18


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed well-spread permutation of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_OF_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _GOLD)


@dataclass
class Words:
    """The words of a run of texts, in order."""

    hash: np.ndarray  # 64 bits of the word's bytes
    doc: np.ndarray  # the text it is in
    start: np.ndarray  # code points of its text before it
    end: np.ndarray
    new_line: np.ndarray  # a line feed or the text's start stands before it
    first: np.ndarray  # number of the first word of each text, and behind the last

    def runs(self, size: int) -> np.ndarray:
        """Whether ``size`` words from each one on are of one text."""
        n = len(self.hash)
        whole = np.zeros(n, bool)
        if n >= size:
            whole[: n - size + 1] = self.doc[: n - size + 1] == self.doc[size - 1 :]
        return whole

    def grams(self, size: int) -> np.ndarray:
        """A hash of the ``size`` words from each one on; only those of :meth:`runs` mean anything."""
        n = len(self.hash)
        total = np.zeros(n, np.uint64)
        for i in range(min(size, n)):
            total[: n - i] = total[: n - i] * _BASE + self.hash[i:]
        return mixed(total + np.uint64(size))


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Slices of a string column of about ``limit`` bytes, with the number of their first text."""
    if not len(column):
        return
    sizes = np.array(pc.fill_null(pc.binary_length(column), 0))
    owner = np.cumsum(sizes) // limit
    starts = np.r_[0, np.flatnonzero(np.diff(owner)) + 1]
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(column)]):
        yield a, column.slice(a, b - a)


def _word_hashes(letters: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A polynomial hash of the bytes of each word, some hundred thousand bytes at a time."""
    if not len(size):
        return np.zeros(0, np.uint64)
    ends = np.cumsum(size)
    total = np.empty(len(size), np.uint64)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(int(size.max()), _BASE, np.uint64))
        first = 0
        while first < len(size):
            offset = ends[first] - size[first]
            last = max(first + 1, int(np.searchsorted(ends, offset + _CHUNK_BYTES)))
            own = size[first:last]
            begin = np.cumsum(own) - own
            place = np.arange(own.sum()) - np.repeat(begin, own)
            total[first:last] = np.add.reduceat(_OF_BYTE[letters[offset : ends[last - 1]]] * power[place], begin)
            first = last
        return mixed(total + size.astype(np.uint64) * _GOLD)


def words(column: pa.Array) -> Words:
    """The words of every text of a string column; NULL has none."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    column = pa.concat_arrays([column])  # without an offset of its own
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    starts_text = np.zeros(len(data) + 1, bool)
    starts_text[offsets[:-1]] = True
    starts_text = starts_text[: len(data)]
    inside = ~_SEPARATOR[data]
    opens = inside & (starts_text | np.r_[True, ~inside[:-1]][: len(data)])
    start = np.flatnonzero(opens)
    closes = inside & np.r_[(starts_text | ~inside)[1:], True][: len(data)]
    end = np.flatnonzero(closes) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    size = end - start
    hashes = _word_hashes(data[inside], size)
    small = np.int32 if len(data) < 2**31 else np.int64
    points = np.cumsum((data & 0xC0) != 0x80, dtype=small)  # code points up to and with each byte
    before = np.r_[0, points][offsets[:-1]][doc].astype(np.int64) if len(data) else np.zeros(0, np.int64)
    lines = np.cumsum(data == 0x0A, dtype=small)
    line = lines[start] if len(start) else np.zeros(0, np.int64)
    new_doc = np.r_[True, doc[1:] != doc[:-1]][: len(doc)]
    new_line = new_doc | np.r_[True, line[1:] != line[:-1]][: len(line)]
    return Words(
        hashes,
        doc,
        points[start] - 1 - before if len(start) else start,
        points[end - 1] - before if len(end) else end,
        new_line,
        np.searchsorted(doc, np.arange(len(column) + 1)),
    )
