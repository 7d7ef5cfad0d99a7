"""Importance resampling towards a target: texts drawn by how much more their features are the target's.

Features are runs of words, hashed into buckets. Bucket counts over all source
and all target texts give each bucket a gain; a text's weight is the mean gain
of its features, its score the weight plus Gumbel noise drawn from its id, and
the highest scores are a weighted sample without replacement.

* Counts and weights are computed over the bytes of a whole piece of text at
  once. A task sends one row per bucket it has seen, so a shuffle carries at
  most the buckets times the tasks; the bucket arrays (80 kB for 10,000 buckets)
  are all that reaches the driver and is broadcast.
* Scores are written once. The cutoff is found by bisection: jobs that only
  count rows at or above some scores, four halvings a job, and then among the
  rows level at that score, the same by id. Nothing is sorted for it.
* Only the rows at or above the cutoff are range-partitioned by score, id and
  place in the table, so that no number of equal rows ends in one task, and
  numbered from the row counts of the partitions.

Results: null is a text without words, has weight 0 and is never drawn, as it
is too short. Ties in score go to the smaller id, null ids last, then to the
smaller number of features; rows still level are interchangeable. The noise of a null id is that of an
empty one. Repeated rows are drawn each by itself. An empty table gives an
empty one; an empty target counts as no features. Extra columns are not returned.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apexlake.llm.common import pieces, text_bytes, word_spans
from apexlake.session import write_once

# Bytes between words once A-Z is folded: all of ASCII but digits and letters.
_BETWEEN = np.zeros(256, bool)
_BETWEEN[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
SHORT = 64  # bytes of a word that are taken side by side with those of other words
HALVINGS = 4  # by one counting job
PARTITION_SHIFT = 33  # monotonically_increasing_id keeps the partition in the bits above this one


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> np.uint32(1)), table >> np.uint32(1))
    return table


_CRC = _crc_table()


def _step(state: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return _CRC[(state ^ byte) & np.uint32(255)] ^ (state >> np.uint32(8))


def _over_words(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 states after the bytes of one word each."""
    length = ends - starts
    order = np.argsort(-length, kind="stable")
    out, begin, length = state[order], starts[order], length[order]
    short = int(np.searchsorted(-length, -SHORT))  # those before it are longer
    for k in range(short):
        crc = zlib.crc32(data[begin[k]:begin[k] + length[k]].tobytes(), int(out[k]) ^ 0xFFFFFFFF)
        out[k] = crc ^ 0xFFFFFFFF
    out, rest, begin, length = out.copy(), out[short:].copy(), begin[short:], length[short:]
    for place in range(int(length[0]) if len(length) else 0):
        n = int(np.searchsorted(-length, -place))
        rest[:n] = _step(rest[:n], data[begin[:n] + place])
    out[short:] = rest
    back = np.empty_like(out)
    back[order] = out
    return back


def features(texts: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text; the bucket of every feature, and the text it belongs to."""
    data, offsets = text_bytes(texts)
    data = _FOLD[data]
    starts, ends, before = word_spans(data, offsets, _BETWEEN)
    words = np.diff(before)
    owner = np.repeat(np.arange(len(words)), words)
    found, owners = [], []
    state, first = np.full(len(starts), 0xFFFFFFFF, np.uint32), np.arange(len(starts))
    for n in range(1, longest + 1):
        if n > 1:
            inside = first + n - 1 < before[1:][owner[first]]
            first = first[inside]
            state = _step(state[inside], np.full(len(first), 0x20, np.uint32))
        last = first + n - 1
        state = _over_words(state, data, starts[last], ends[last])
        found.append((state ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets))
        owners.append(owner[first])
    return words, np.concatenate(found).astype(np.int64), np.concatenate(owners)


def bucket_counts(docs: DataFrame, text: str, longest: int, buckets: int) -> np.ndarray:
    """Features in each bucket over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in pieces(batch, "text"):
                total += np.bincount(features(piece.column("text"), longest, buckets)[1], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.collect():  # at most one row per bucket
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of how much more often a bucket is met in the target, each count raised by one."""
    buckets = len(source)
    of_source, of_target = float(source.sum() + buckets), float(target.sum() + buckets)
    return np.array([
        math.floor(1000 * math.log((t + 1) * of_source / ((s + 1) * of_target)))
        for s, t in zip(source.tolist(), target.tolist())
    ], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, longest: int, id_column: str, text: str) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for batch in batches:
            for piece in pieces(batch, "text"):
                words, bucket, owner = features(piece.column("text"), longest, len(gain))
                count = np.bincount(owner, minlength=len(words))
                order = np.argsort(owner, kind="stable")
                total = np.r_[0, np.cumsum(gain[bucket[order]])]
                ends = np.cumsum(count)
                weight = (total[ends] - total[ends - count]) // np.maximum(count, 1)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), *map(pa.array, (words, count, weight))],
                    names=["doc_id", "n_words", "n_features", "weight"])

    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate that the id draws."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") + 0.5) / 4294967296
    return F.floor(-1000 * F.ln(-F.ln(uniform)))


def least_with(rows: DataFrame, value: Column, wanted: int) -> int | None:
    """The smallest integer that at least ``wanted`` rows do not exceed, by bisection; None if fewer rows have a value.

    Each job counts rows at the cut points of ``HALVINGS`` halvings at once.
    """
    low, high, known = rows.agg(F.min(value), F.max(value), F.count(value)).first()
    if known < wanted or low is None:
        return None
    while low < high:
        parts = 1 << HALVINGS
        points = sorted({low + (high - low) * i // parts for i in range(1, parts)} - {high} | {(low + high) // 2})
        counts = rows.agg(*[F.count_if(value <= F.lit(p).cast("bigint")) for p in points]).first()
        for point, count in zip(points, counts):
            if count >= wanted:
                high = point
                break
            low = point + 1
    return low


def _numbered(rows: DataFrame) -> DataFrame:
    """``rank`` 1, 2, .. by score, id and place, over any number of tasks."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(), F.col("place").asc()]
    placed = write_once(rows.orderBy(*order).withColumn("seq", F.monotonically_increasing_id()), "importance-ranks")
    placed = placed.withColumn("part", F.shiftright("seq", PARTITION_SHIFT))
    sizes = placed.groupBy("part").agg(F.min("seq").alias("first"), F.count("*").alias("n")).orderBy("part").collect()
    shifts, done = [], 0
    for part, first, n in sizes:  # one row per task of the sort
        shifts.append((part, done + 1 - first))
        done += n
    shift = rows.sparkSession.createDataFrame(shifts, "part long, shift long")
    return placed.join(F.broadcast(shift), "part").withColumn("rank", F.col("seq") + F.col("shift"))


def resample(
    docs: DataFrame, target: DataFrame, percent: int, least_words: int, seed: int, longest: int = 1, buckets: int = 10_000,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row; the rank of what is not drawn is null.

    Of the rows with at least ``least_words`` words, ``percent`` in a hundred are
    drawn, rounded down. Features are the runs of 1 to ``longest`` words.
    """
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, text, longest, buckets))
    weighed = weigh(docs, gain, longest, id_column, text)
    scored = write_once(
        weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
        .withColumn("place", F.monotonically_increasing_id()), "importance-scores")
    fit = scored.where(F.col("n_words") >= least_words)
    wanted = fit.count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("bigint").alias("rank")
    if not wanted:
        return scored.select(*columns, none)
    negated = least_with(fit, -F.col("score"), wanted)
    level = fit.where(F.col("score") == -negated)
    above = fit.where(F.col("score") > -negated).count()
    last = least_with(level, F.col("doc_id"), wanted - above)
    drawn = F.col("score") > -negated
    tied = F.lit(True) if last is None else F.coalesce(F.col("doc_id") <= last, F.lit(False))
    drawn = (F.col("n_words") >= least_words) & (drawn | ((F.col("score") == -negated) & tied))
    ranked = _numbered(scored.where(drawn))
    rank = F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank")
    return scored.where(~drawn).select(*columns, none).unionByName(ranked.select(*columns, rank))
