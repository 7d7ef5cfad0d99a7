"""Helpers the operators share: reading, row keys, Arrow pieces, words as hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from apexlake.session import write_once

# Bytes of text handled at once inside a task. One longer text is a piece of its own.
PIECE_BYTES = 4 << 20
# Broadcast a table only below this counted number of rows and this measured size, as JSON.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character stays as it is."""
    return F.translate(text, UPPER, LOWER)


def unused(df: DataFrame, name: str) -> str:
    """A beginning for names of inner columns that no column of the table has, in whatever case."""
    taken = [c.lower() for c in df.columns]
    start = f"_{name}"
    while any(c.startswith(start) for c in taken):
        start = "_" + start
    return start


def row_key(doc_id: str, text: str) -> Column:
    """Tells rows of one id with different texts apart; repeated rows share a key, as they share results."""
    return F.xxhash64(F.col(text), F.col(doc_id))


def small(df: DataFrame, label: str) -> DataFrame:
    """The table written once, marked for broadcast if its counted rows and their measured size allow it."""
    written = write_once(df, label)
    if written.count() > BROADCAST_ROWS:
        return written
    size = written.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(written) if size <= BROADCAST_BYTES else written


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // limit
    edges = np.flatnonzero(np.diff(part)) + 1
    for start, end in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
        yield batch.slice(start, end - start)


@contextmanager
def batches_of(spark: SparkSession, limit: int) -> Iterator[None]:
    """Jobs run meanwhile send Python about ``limit`` bytes of rows at a time, one row at least.

    Otherwise a batch is 10,000 rows, however long they are, and is held by the JVM (beyond its heap) and by Python.
    """
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, str(limit))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def append_columns(
    df: DataFrame, column: str, fields: T.StructType, make: Callable[[], Callable], limit: int = PIECE_BYTES,
) -> DataFrame:
    """Add columns computed from one text column, piece by piece of about ``limit`` bytes.

    ``make()`` runs once per task and returns a function from a string array to
    one array per field. An input column named like a field is replaced.
    """
    kept = [c for c in df.columns if c not in fields.names or c == column]
    rest = [c for c in kept if c not in fields.names]
    out = T.StructType([*[df.schema[c] for c in rest], *fields.fields])
    types = [f.type for f in to_arrow_schema(fields)]

    def run(batches):
        function = make()
        for batch in batches:
            for piece in pieces(batch, column, limit):
                made = function(piece.column(column))
                arrays = [piece.column(c) for c in rest] + [pa.array(x, kind) for x, kind in zip(made, types)]
                yield pa.RecordBatch.from_arrays(arrays, names=out.names)

    return df.select(*kept).mapInArrow(run, out)


# Words as 64-bit hashes, computed over the bytes of a whole piece at once.
_B = np.uint64(0x9E3779B97F4A7C17)  # fixed: odd, and 3 modulo 4
_INV = np.uint64(pow(int(_B), -1, 1 << 64))
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _BYTE.copy()
_FOLDED[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        filled = np.full(n, base, np.uint64)
        filled[0] = 1
        _powers[kind] = np.multiply.accumulate(filled)
    return _powers[kind][:n]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the offset of each text; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def word_spans(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = _SPACE,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word (a run without separators, by default white space), and words before each text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~separators[data]
    before = np.empty_like(word)
    before[0], before[1:] = False, word[:-1]
    edges = offsets[offsets < len(data)]
    before[edges] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty_like(word)
    after[-1], after[:-1] = False, word[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word with A-Z folded: a polynomial over its bytes, scrambled."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_FOLDED[data] * _power("up", _B, len(data)), out=total[1:])
    value = (total[ends] - total[starts]) * _power("down", _INV, len(data))[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
