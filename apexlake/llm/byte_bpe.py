"""Byte-level BPE encoding in length-bucketed padded matrices, and decoding by table.

The vocabulary is a list of byte strings with ranks, read once on the driver
and sent to the tasks: about 1 MB, bounded by the vocabulary. Texts stay where
they are; nothing is shuffled. A piece of text is cut into pre-tokens by the
pattern, and each distinct pre-token is merged once:

* pre-tokens of 2, 3-4, 5-8, .. bytes share a matrix, one symbol a cell, padded
  to the longest; its twin holds the rank of each pair of neighbours;
* in a round every row merges its leftmost pair of minimum rank, the cells
  behind it move up by one, and the two pairs beside it are looked up anew in an
  open-addressed hash table; rows without a pair leave the matrix;
* pre-tokens beyond ``WIDEST`` bytes would make rounds as many as bytes over all
  of them: they are merged one by one in the same order, with a heap.

Two symbols form a pair if their bytes together are in the vocabulary; the rank
is that of the whole, however it came about.

Results: null is an empty text and has no tokens. Texts hold no special tokens.
Repeated rows get equal results, an empty table gives an empty one, extra
columns pass through, and an input column named like a result is replaced.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from apexlake.llm.bpe import Memory
from apexlake.llm.common import append_columns

WIDEST = 256
NONE = np.int64(1) << 40  # the rank of what is no pair
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Ranks of symbol pairs in an open-addressed hash table, looked up for whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        bits = max(4, int(4 * len(rank)).bit_length())  # between a quarter and an eighth full
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NONE, np.int64)
        key = self._key(left, right)
        slot = self._slot(key)
        while len(key):
            free = np.flatnonzero(self.keys[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.ranks[slot[put]] = key[put], rank[put]
            rest = np.ones(len(key), bool)
            rest[put] = False
            key, rank, slot = key[rest], rank[rest], (slot[rest] + 1) & self.mask

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.int64) << 32 | right.astype(np.int64)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * _SPREAD >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NONE`` where there is none or a symbol is padding (below 0)."""
        out = np.full(left.shape, NONE, np.int64)
        asked = np.flatnonzero((left >= 0) & (right >= 0))
        key = self._key(left.ravel()[asked], right.ravel()[asked])
        slot, flat = self._slot(key), out.ravel()
        while len(asked):
            held = self.keys[slot]
            same = held == key
            flat[asked[same]] = self.ranks[slot[same]]
            on = ~same & (held >= 0)
            asked, key, slot = asked[on], key[on], (slot[on] + 1) & self.mask
        return flat.reshape(left.shape)


class ByteVocabulary:
    """Byte strings and their ranks, which are their ids."""

    def __init__(self, source: bytes, pattern: str):
        pairs = [line.split() for line in source.splitlines() if line]
        self.ranks: dict[bytes, int] = {base64.b64decode(token): int(rank) for token, rank in pairs}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("every single byte needs a rank")
        self.pattern = regex.compile(pattern)
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        splits = [
            (self.ranks[token[:i]], self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items() for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        self.pairs = PairTable(*np.array(splits, np.int64).reshape(-1, 3).T)
        self.joined = {(a, b): rank for a, b, rank in splits}
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def pre_tokens(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def merge(self, words: list[str]) -> list[bytes]:
        """The ids of distinct pre-tokens, each as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        raw = [w.encode() for w in words]
        length = np.array([len(w) for w in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        start = np.cumsum(length) - length
        width = 1
        while width <= WIDEST:
            rows = np.flatnonzero((length > width // 2) & (length <= width))
            if len(rows):
                cells = np.arange(int(length[rows].max()))
                inside = cells < length[rows, None]
                at = np.where(inside, start[rows, None] + cells, 0)
                self._merge_rows(rows, np.where(inside, self.of_byte[data[at]], -1), out)
            width *= 2
        for row in np.flatnonzero(length > WIDEST).tolist():
            out[row] = self._merge_long(raw[row])
        return out

    def _merge_rows(self, rows: np.ndarray, symbols: np.ndarray, out: list[bytes]) -> None:
        """Merge all rows of a padded matrix, one pair a row and round."""
        ranks = self.pairs.look_up(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            each = np.arange(len(rows))
            if ranks.shape[1]:
                at = ranks.argmin(axis=1)
                best = ranks[each, at]
            else:
                at, best = np.zeros(len(rows), np.int64), np.full(len(rows), NONE)
            done = best == NONE
            if done.any():
                self._give(rows[done], symbols[done], out)
                rows, symbols, ranks, at, best = (x[~done] for x in (rows, symbols, ranks, at, best))
                each = np.arange(len(rows))
                if not len(rows):
                    return
            symbols[each, at] = best
            cells = np.arange(symbols.shape[1] - 1)
            symbols = np.take_along_axis(symbols, cells + (cells > at[:, None]), 1)
            cells = cells[:-1]
            ranks = np.take_along_axis(ranks, cells + (cells >= at[:, None]), 1)
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.pairs.look_up(symbols[left, at[left] - 1], best[left])
            right = np.flatnonzero(at < ranks.shape[1])
            ranks[right, at[right]] = self.pairs.look_up(best[right], symbols[right, at[right] + 1])

    @staticmethod
    def _give(rows: np.ndarray, symbols: np.ndarray, out: list[bytes]) -> None:
        kept = symbols >= 0
        ends = np.cumsum(kept.sum(axis=1)) * 4
        flat = symbols[kept].astype("<u4").tobytes()
        for row, s, e in zip(rows.tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
            out[row] = flat[s:e]

    def _merge_long(self, word: bytes) -> bytes:
        """One long pre-token, pair by pair in order of rank and place, through a heap and links."""
        symbol = self.of_byte[np.frombuffer(word, np.uint8)].tolist()
        n = len(symbol)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        found = self.joined.get
        heap = [(rank, i, a, b) for i, (a, b) in enumerate(zip(symbol, symbol[1:])) if (rank := found((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j < 0 or symbol[i] != a or symbol[j] != b:
                continue
            symbol[i], symbol[j] = rank, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (made := found((rank, symbol[k]))) is not None:
                    heapq.heappush(heap, (made, i, rank, symbol[k]))
            h = before[i]
            if h >= 0 and (made := found((symbol[h], rank))) is not None:
                heapq.heappush(heap, (made, h, symbol[h], rank))
        return np.array([s for s in symbol if s >= 0], "<u4").tobytes()

    def text_of(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """All bytes that an array of ids stands for, and where those of each id end. An id without a token has none."""
        ids = ids.astype(np.int64)
        known = (ids >= 0) & (ids < len(self.lengths))
        ids = np.where(known, ids, 0)
        length = np.where(known, self.lengths[ids], 0)
        ends = np.cumsum(length)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - (ends - length), length)
        return self.bytes[at].tobytes(), ends


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


_loaded: dict[tuple[str, str], ByteVocabulary] = {}


def _vocabulary(source: bytes, pattern: str) -> ByteVocabulary:
    """One per worker process, whatever the number of tasks."""
    key = hashlib.sha256(source).hexdigest(), pattern
    if key not in _loaded:
        _loaded[key] = ByteVocabulary(source, pattern)
    return _loaded[key]


def _encoded(vocabulary: ByteVocabulary, memory: Memory, texts: pa.Array) -> list[bytes]:
    lists = [vocabulary.pre_tokens(t) if t else [] for t in texts.to_pylist()]
    memory.know(lists)
    return [b"".join(map(memory.__getitem__, words)) for words in lists]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """Add the ids of each text as an array."""
    source = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def make():
        vocabulary = _vocabulary(source.value, pattern)
        memory = Memory({}, vocabulary.merge)

        def run(texts):
            ids = _encoded(vocabulary, memory, texts)
            offsets = np.cumsum([0, *[len(i) // 4 for i in ids]])
            return (pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4"))),)

        return run

    return append_columns(docs, text, T.StructType([T.StructField(out, T.ArrayType(T.IntegerType()))]), make)


def decode(docs: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Add the bytes that an array of ids stands for: null for null, and nothing for a null or unknown id."""
    source = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    kept = [c for c in docs.columns if c != out]
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(out, T.BinaryType())])

    def run(batches):
        vocabulary = _vocabulary(source.value, "")
        for batch in batches:
            made = []
            for own in batch.column(ids):  # row by row: one text of any length, never a whole batch
                values = own.as_py()
                made.append(None if values is None else vocabulary.text_of(np.array([-1 if i is None else i for i in values], np.int64))[0])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(made, pa.binary())], names=schema.names)

    return docs.select(*kept).mapInArrow(run, schema)


DIGEST = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
])


def encode_digest(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Add the number of tokens and digests of the ids and of the bytes they stand for, without keeping either."""
    source = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def make():
        vocabulary = _vocabulary(source.value, pattern)
        memory = Memory({}, vocabulary.merge)

        def run(texts):
            ids = _encoded(vocabulary, memory, texts)
            counts = [len(i) // 4 for i in ids]
            decoded, ends = vocabulary.text_of(np.frombuffer(b"".join(ids), "<u4"))
            cuts = np.r_[0, ends][np.cumsum([0, *counts])].tolist()
            return (
                counts, [hashlib.sha256(i).hexdigest() for i in ids],
                [hashlib.sha256(decoded[s:e]).hexdigest() for s, e in zip(cuts, cuts[1:])],
            )

        return run

    return append_columns(docs, text, DIGEST, make)
