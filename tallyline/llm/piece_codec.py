"""Byte-pair encoding with SentencePiece vocabularies, in vectorised merge rounds.

The words of a block of texts are laid out as one flat array of symbols. A round looks up the rank of
every neighbouring pair, takes the least rank of each word (a segmented minimum), merges all its
occurrences from the left, and closes the gaps; words without a mergeable pair leave. What a
word becomes doesn't depend on the text around it, since no piece has a space after another
character; so each distinct word of a block is merged once, and a bounded table keeps recent words.

Rounds equal the one-by-one merging of the library unless two different pairs have one rank, or a merge
makes a pair of a lower rank than its own; words where that can happen, and very long ones, are merged
one pair at a time with a heap.

Defined results: a NULL or empty text gives the end id alone and decodes to the empty string; characters outside the
vocabulary become the byte pieces of their UTF-8 form; repeated rows give repeated rows; empty input
gives no rows. The file's path is a parameter and is read on the driver only: executors get the pieces.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

SPACE = "▁"
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*")
_NONE = np.iinfo(np.int32).max
# Words kept between blocks, characters of text in a block, and symbols above which a word takes the heap.
KEPT_WORDS = 400_000
BLOCK_CHARS = 1_000_000
HEAP_SYMBOLS = 256


def read_vocabulary(path: str) -> dict:
    """Pieces, scores and kinds of a BPE model with byte fallback, a dummy prefix and no other normalisation."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules, trainer = model.normalizer_spec, model.trainer_spec
    plain = rules.add_dummy_prefix and not rules.remove_extra_whitespaces and not rules.precompiled_charsmap
    if trainer.model_type != 2 or not trainer.byte_fallback or not plain:
        raise ValueError(f"{path} is not a byte-fallback BPE model without text normalisation")
    return {
        "pieces": [p.piece for p in model.pieces],
        "scores": [p.score for p in model.pieces],
        "normal": [p.type == 1 for p in model.pieces],
        "byte": [p.type == 6 for p in model.pieces],
        "end": next(i for i, p in enumerate(model.pieces) if p.piece == "</s>"),
    }


class PieceCodec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocabulary: dict, kept_words: int = KEPT_WORDS):
        pieces, self.end = vocabulary["pieces"], vocabulary["end"]
        self.symbols = {p: i for i, p in enumerate(pieces) if vocabulary["normal"][i]}
        if any(SPACE in p.lstrip(SPACE) for p in self.symbols):
            raise ValueError("a piece goes on after a space: words can't be merged on their own")
        self.size = len(pieces)
        for char in sorted({c for p in self.symbols for c in p if c not in self.symbols}):
            self.symbols[char] = len(self.symbols) + self.size  # in pieces, but none itself
        self.byte_id = np.zeros(256, np.int32)
        for i, p in enumerate(pieces):
            if vocabulary["byte"][i]:
                self.byte_id[int(p[3:5], 16)] = i
        self.bytes_as_ids = self.byte_id.tolist()
        self.no_piece = {i: c for c, i in self.symbols.items() if i >= self.size}
        order = {score: rank for rank, score in enumerate(sorted({-s for s in vocabulary["scores"]}))}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for piece, i in self.symbols.items():
            for cut in range(1, len(piece)):
                left, right = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if left is not None and right is not None:
                    self.pairs[left, right] = (order[-vocabulary["scores"][i]], i)
        self.base = self.size + len(self.symbols) + 0x110000 + 1  # other characters stand above all symbols
        keys = np.array([a * self.base + b for a, b in self.pairs], np.int64)
        sort = np.argsort(keys)
        self.keys = np.r_[keys[sort], np.iinfo(np.int64).max]
        self.ranks = np.r_[np.array([r for r, _ in self.pairs.values()], np.int32)[sort], _NONE].astype(np.int32)
        self.merged = np.r_[np.array([i for _, i in self.pairs.values()], np.int32)[sort], 0].astype(np.int32)
        self.of_char = {c: i for c, i in self.symbols.items() if len(c) == 1}
        self.other = self.size + len(self.symbols)
        # Ranks that several pieces share: only there can two different pairs tie.
        by_rank = np.bincount([order[-vocabulary["scores"][i]] for i in self.symbols.values() if i < self.size])
        shared = np.flatnonzero(by_rank > 1)
        self.tied = {r for r, _ in self.pairs.values()} & set(shared.tolist())
        self.text = [p.replace(SPACE, " ").encode() if vocabulary["normal"][i] else b"" for i, p in enumerate(pieces)]
        for value, i in enumerate(self.byte_id):
            self.text[i] = bytes([value])
        self.kept_words = kept_words
        self.known: dict[str, bytes] = {}

    # --- one word at a time -------------------------------------------------------------------

    def _symbols_of(self, word: str) -> list[int]:
        return [self.of_char.get(c, self.other + ord(c)) for c in word]

    def merge_with_heap(self, word: str) -> list[int]:
        """Merging pair by pair: the best score first, the leftmost of equals."""
        symbol = self._symbols_of(word)
        after = [*range(1, len(symbol)), -1]
        before = [*range(-1, len(symbol) - 1)]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (found := self.pairs.get((symbol[i], symbol[j]))):
                heapq.heappush(heap, (found[0], i, symbol[i], symbol[j], found[1]))

        for i in range(len(symbol) - 1):
            offer(i)
        while heap:
            _, i, left, right, new = heapq.heappop(heap)
            j = after[i]
            if symbol[i] != left or j < 0 or symbol[j] != right:
                continue
            symbol[i], symbol[j] = new, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [s for s in symbol if s >= 0]

    # --- many words at once -------------------------------------------------------------------

    def merge_words(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words after all merges, one word behind the other, and the number for each word."""
        slow = {i for i, w in enumerate(words) if len(w) > HEAP_SYMBOLS}
        fast = [i for i in range(len(words)) if i not in slow]
        points = np.frombuffer("".join(words[i] for i in fast).encode("utf-32-le"), np.uint32)
        chars, place = np.unique(points, return_inverse=True)
        table = np.array([self.of_char.get(chr(c), self.other + int(c)) for c in chars.tolist()], np.int64)
        symbol = table[place] if len(chars) else np.zeros(0, np.int64)
        owner = np.repeat(np.array(fast, np.int64), [len(words[i]) for i in fast])
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        last_rank = np.full(len(words), -1, np.int32)
        last_many = np.zeros(len(words), bool)
        tied = np.array(sorted(self.tied), np.int32)
        rank, merged = self._looked_up(symbol, owner, np.arange(len(symbol)))
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            least = np.minimum.reduceat(rank, starts)
            present, sizes = owner[starts], np.diff(np.r_[starts, len(symbol)])
            # A lower rank after a round of several merges: the order could differ from the library's.
            unsure = ((least < last_rank[present]) & last_many[present]) | np.isin(least, tied)
            slow.update(present[unsure].tolist())
            over = unsure | (least == _NONE)
            leaving = np.repeat((least == _NONE) & ~unsure, sizes)
            found.append((owner[leaving], symbol[leaving]))
            staying = np.repeat(~over, sizes)
            index = np.flatnonzero((rank == np.repeat(least, sizes)) & staying)
            run = np.r_[True, np.diff(index) > 1][: len(index)]
            run_start = index[run][np.cumsum(run) - 1] if len(index) else index
            index = index[(index - run_start) % 2 == 0]
            last_rank[present] = least
            last_many = np.bincount(owner[index], minlength=len(words)) > 1
            symbol[index] = merged[index]
            staying[index + 1] = False
            # Ranks change only where a merged symbol is the left or right one of a pair.
            place = np.cumsum(staying) - 1
            symbol, owner, rank, merged = symbol[staying], owner[staying], rank[staying], merged[staying]
            near = np.zeros(len(symbol), bool)
            near[place[index]] = near[np.maximum(place[index] - 1, 0)] = True
            touched = np.flatnonzero(near)
            rank[touched], merged[touched] = self._looked_up(symbol, owner, touched)
        for i in slow:
            own = np.array(self.merge_with_heap(words[i]), np.int64)
            found.append((np.full(len(own), i), own))
        owners, symbols = (np.concatenate(column) for column in zip(*found))
        return symbols[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(words))

    def _looked_up(self, symbol: np.ndarray, owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging the symbols at ``at`` with the next ones."""
        right = np.minimum(at + 1, len(symbol) - 1)
        key = symbol[at] * self.base + symbol[right]
        place = np.searchsorted(self.keys, key)
        known = (self.keys[place] == key) & (owner[at] == owner[right]) & (at < right)
        return np.where(known, self.ranks[place], _NONE).astype(np.int32), np.where(known, self.merged[place], 0)

    def _ids(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols as piece ids; a character that is no piece as the pieces of its bytes."""
        odd = np.flatnonzero(symbols >= self.size)
        if not len(odd):
            return symbols.astype(np.int32), counts
        spelled: dict[int, list[int]] = {}
        for s in np.unique(symbols[odd]).tolist():
            char = chr(s - self.other) if s >= self.other else self.no_piece[s]
            spelled[s] = [self.bytes_as_ids[b] for b in char.encode()]
        out = [spelled[s] for s in symbols[odd].tolist()]
        wide = np.ones(len(symbols), np.int64)
        wide[odd] = [len(ids) for ids in out]
        ids = np.repeat(symbols, wide).astype(np.int32)
        at = np.repeat(np.cumsum(wide)[odd] - wide[odd], wide[odd])
        step = np.arange(len(at)) - np.repeat(np.cumsum(wide[odd]) - wide[odd], wide[odd])
        ids[at + step] = np.concatenate(out)
        word = np.repeat(np.arange(len(counts)), counts)
        return ids, np.bincount(word, weights=wide, minlength=len(counts)).astype(np.int64)

    def _learn(self, words: Sequence[str]) -> None:
        ids, counts = self._ids(*self.merge_words(words))
        flat, ends = ids.tobytes(), (np.cumsum(counts) * 4).tolist()
        self.known.update(zip(words, [flat[a:b] for a, b in zip([0, *ends], ends)]))

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text, with the end id, as the bytes of 32-bit integers."""
        split = []
        for text in texts:
            if not text:
                split.append([])
                continue
            line = SPACE + text.replace(" ", SPACE)
            split.append(_WORD.findall(line))
        known = self.known
        fresh = list({w for words in split for w in words if w not in known})
        if len(known) + len(fresh) > self.kept_words:
            known.clear()
            fresh = list({w for words in split for w in words})
        self._learn(fresh)
        end = np.array([self.end], np.int32).tobytes()
        found = known.__getitem__
        return [b"".join(map(found, words)) + end for words in split]

    def decode(self, ids: Sequence[int]) -> str:
        """Pieces joined, byte pieces read as UTF-8, without the dummy prefix."""
        line = b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace")
        return line[1:] if line.startswith(" ") else line


def _blocks(texts: Sequence[str | None]) -> Iterator[slice]:
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= BLOCK_CHARS:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def encode_decode(documents: DataFrame, path: str, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of every document, ``ids`` of its whole ``text`` with the end id, and ``decoded``.

    One narrow pass; texts go to the Python workers in Arrow batches and in blocks of about a million characters.
    """
    vocabulary = documents.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    keep = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(vocabulary.value)
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            for block in _blocks(texts):
                encoded = codec.encode(texts[block])
                flat = np.frombuffer(b"".join(encoded), np.int32)
                offsets = np.r_[0, np.cumsum([len(e) // 4 for e in encoded])].astype(np.int32)
                decoded = [codec.decode(np.frombuffer(e, np.int32).tolist()) for e in encoded]
                columns = [column.slice(block.start, len(encoded)) for column in batch.columns[:-1]]
                columns += [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*keep, "ids", "decoded"])

    fields = [documents.schema[name] for name in keep]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    return documents.select(*keep, "text").mapInArrow(run, T.StructType(fields))
