"""SimHash near-duplicates, linked by anchor-point covering.

Fingerprints that differ in at most ``max_bits`` bits are linked. The 64 bits
are dealt over three blocks, so two linked fingerprints differ in at most
``max_bits // 3`` bits of one block. In each block a covering code supplies the
anchors: the perfect Hamming(15, 11) code on 15 bits (every pattern is within
one bit of exactly one code word) times all patterns of the other bits. A
fingerprint goes to every anchor within the covering radius plus the block's
threshold, which are the anchors nearest to the patterns within the threshold.
The anchor nearest to one of two linked fingerprints then holds both, and all
fingerprints at an anchor are compared over their whole 64 bits.

One code over all 64 bits would need about a thousand copies of a fingerprint
for a threshold of four (two Golay codes side by side); three blocks need 42.

Equal fingerprints are collapsed before, so copies cost nothing. An anchor
reports its links as a forest, never as all pairs. Groups of close
fingerprints are walked breadth first, where each step leaves fewer to
compare; a crowded anchor is dealt once more by the bits of the other blocks.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apexlake.llm.common import append_columns
from apexlake.llm.components import components
from apexlake.session import write_once

BLOCKS = ((0, 22), (22, 21), (43, 21))  # first bit and number of bits
CODE_BITS = 15
CROWDED = 2_048  # fingerprints at one anchor that are dealt once more


def fingerprint(text: str | None, shingle: int, seed: int = 42) -> int:
    """SimHash of the word shingles of one text, as a signed 64-bit number.

    A-Z count as lower case, words are runs without white space, shingles are
    joined by one space, repeats count. A shorter text is one shingle; a null
    text or one without words has fingerprint 0.
    """
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    upto = ends[min(shingle, len(words)) - 1:]
    hashes = np.array([digest(joined[s:e], seed) for s, e in zip(starts[:n].tolist(), upto.tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for part in np.array_split(hashes, len(hashes) // 4096 + 1):
        ones += np.unpackbits(part.astype(">u8").view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n)
    return int(bits.view(">i8")[0])


def _nearest_word() -> np.ndarray:
    """The Hamming code word within one bit of each pattern of 15 bits."""
    patterns = np.arange(1 << CODE_BITS)
    syndrome = np.zeros_like(patterns)
    for bit in range(CODE_BITS):
        syndrome ^= np.where(patterns >> bit & 1, bit + 1, 0)
    return np.where(syndrome, patterns ^ (1 << np.maximum(syndrome - 1, 0)), patterns)


_NEAREST = _nearest_word()


def _anchor(block: np.ndarray) -> np.ndarray:
    """The anchor nearest to a block's bits: code word for the low 15 bits, the other bits as they are."""
    return block >> CODE_BITS << CODE_BITS | _NEAREST[block & ((1 << CODE_BITS) - 1)]


def _flips(width: int, most: int) -> list[int]:
    return [sum(1 << b for b in bits) for k in range(most + 1) for bits in combinations(range(width), k)]


def anchors(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``(anchor, index of the value)`` for every anchor a fingerprint goes to."""
    found, owners = [], []
    for number, (first, width) in enumerate(BLOCKS):
        block = (values >> np.uint64(first) & np.uint64((1 << width) - 1)).astype(np.int64)
        reached = np.stack([_anchor(block ^ flip) for flip in _flips(width, max_bits // len(BLOCKS))])
        reached.sort(axis=0)
        fresh = np.ones_like(reached, bool)
        fresh[1:] = reached[1:] != reached[:-1]
        found.append(reached[fresh] | number << 60)
        owners.append(np.broadcast_to(np.arange(len(values)), reached.shape)[fresh])
    return np.concatenate(found), np.concatenate(owners)


def _walk(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among a group, as pairs of indexes."""
    open_, forest = np.arange(len(values)), []
    while len(open_) > 1:
        queue, open_ = [int(open_[0])], open_[1:]
        while queue and len(open_):
            own = queue.pop()
            near = np.bitwise_count(values[open_] ^ values[own]) <= max_bits
            if near.any():
                reached = open_[near].tolist()
                forest += [(own, other) for other in reached]
                queue += reached
                open_ = open_[~near]
    return forest


def _link_crowd(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of a crowded anchor: dealt over narrower blocks, then walked."""
    forest = []
    for first in range(0, 64, 13):  # five blocks: one of them differs in no bit if at most four do
        block = values >> np.uint64(first) & np.uint64((1 << 13) - 1)
        flips = [np.uint64(f) for f in _flips(13, max_bits // 5)]
        keys = np.concatenate([block ^ f for f in flips])
        owners = np.tile(np.arange(len(values)), len(flips))
        order = np.argsort(keys, kind="stable")
        keys, owners = keys[order], owners[order]
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for group in np.split(owners, cuts):
            if len(group) > 1:
                forest += [(int(group[a]), int(group[b])) for a, b in _walk(values[group], max_bits)]
    return forest


def _links(keys: np.ndarray, values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among values sorted by their anchor."""
    starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
    sizes = np.diff(np.append(starts, len(keys)))
    left, right = [], []
    # Anchors with a few fingerprints: neighbours at each distance, over all anchors at once.
    some = np.repeat(sizes <= 8, sizes)
    few_keys, few = keys[some], values[some]
    for step in range(1, 8):
        near = (few_keys[step:] == few_keys[:-step]) & (np.bitwise_count(few[step:] ^ few[:-step]) <= max_bits)
        left.append(few[:-step][near])
        right.append(few[step:][near])
    for start, size in zip(starts[sizes > 8].tolist(), sizes[sizes > 8].tolist()):
        own = values[start:start + size]
        pairs = np.array((_walk if size <= CROWDED else _link_crowd)(own, max_bits), np.int64).reshape(-1, 2)
        left.append(own[pairs[:, 0]])
        right.append(own[pairs[:, 1]])
    return np.concatenate(left), np.concatenate(right)


def link_fingerprints(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links ``(u, v)`` among the distinct non-null longs of the column ``fp``, enough to connect all that are linked.

    Null is not a fingerprint. No rows give no links.
    """

    def deal(batches):
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            keys, owners = anchors(values, max_bits)
            for s in range(0, len(keys), 1 << 19):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[s:s + (1 << 19)]), pa.array(values[owners[s:s + (1 << 19)]].view(np.int64))], names=["anchor", "fp"])

    def compare(batches):
        rest_keys, rest = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def told(keys, values):
            if len(keys):
                u, v = _links(keys, values, max_bits)
                pairs = np.unique(np.stack([u, v], axis=1), axis=0) if len(u) else np.zeros((0, 2), np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[:, 0].view(np.int64)), pa.array(pairs[:, 1].view(np.int64))], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, values = batch.column("anchor").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)
            waiting.append((keys, values))
            if keys[0] == keys[-1] and (len(waiting) == 1 or waiting[0][0][0] == keys[0]):
                continue  # one anchor so far
            keys = np.concatenate([k for k, _ in waiting])
            values = np.concatenate([v for _, v in waiting])
            cut = int(np.searchsorted(keys, keys[-1]))
            yield from told(keys[:cut], values[:cut])
            waiting = [(keys[cut:], values[cut:])]
        if waiting:
            rest_keys = np.concatenate([k for k, _ in waiting])
            rest = np.concatenate([v for _, v in waiting])
        yield from told(rest_keys, rest)

    distinct = prints.select("fp").where("fp IS NOT NULL").distinct()
    dealt = distinct.mapInArrow(deal, "anchor long, fp long")
    placed = dealt.repartition("anchor").sortWithinPartitions("anchor")
    return placed.mapInArrow(compare, "u long, v long")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, classes)``: every row's ``doc_id, text_hash, fp``, and ``fp, root, component_id`` for every fingerprint.

    Texts become fingerprints in one pass over the documents, without a
    shuffle; from then on only fingerprints move. ``component_id`` is the
    smallest id reachable over links, its own included; null if no row of the
    component has an id. Repeated rows have equal fingerprints and so share a
    component; ``root`` is a fingerprint of the component and tells components
    apart also where unrelated texts have one id. Null and wordless texts have fingerprint 0, linked like any
    other. Other columns of ``docs`` are not read. An empty table gives none.
    """

    def make():
        return lambda texts: ([fingerprint(t, shingle) for t in texts.to_pylist()],)

    own = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("_text"))
    made = append_columns(own, "_text", T.StructType([T.StructField("fp", T.LongType())]), make).drop("_text")
    rows = write_once(made, "simhash")
    first = write_once(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    linked = components(link_fingerprints(first, max_bits))
    placed = write_once(
        first.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "placed")
    # Written, so that both sides of the join come straight from a shuffle and AQE can split a large component.
    smallest = write_once(placed.groupBy("root").agg(F.min("first_id").alias("component_id")), "smallest")
    return rows, write_once(placed.join(smallest, "root").select("fp", "root", "component_id"), "classes")


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of each group of near-duplicates, with all columns.

    The row with the smallest id stays; among rows of that id the one with the
    smallest hash of its text; of equal rows one. A group without any id keeps
    one row in the same way.
    """
    rows, classes = near_duplicates(docs, doc_id, text, shingle, max_bits)
    placed = rows.join(classes, "fp")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    kept = placed.groupBy("root").agg(F.min(order).alias("_row")).select(F.col("_row.doc_id").alias("doc_id"), F.col("_row.text_hash").alias("text_hash"))
    counted = write_once(rows.join(kept, F.expr("true") & rows["doc_id"].eqNullSafe(kept["doc_id"]) & (rows["text_hash"] == kept["text_hash"]))
                         .groupBy(kept["doc_id"], kept["text_hash"]).agg(F.count("*").alias("n")), "kept")
    same = F.xxhash64(docs[text]) == counted["text_hash"]
    found = docs.join(counted, docs[doc_id].eqNullSafe(counted["doc_id"]) & same)
    single = found.where(counted["n"] == 1).select(*[docs[c] for c in docs.columns])
    several = found.where(counted["n"] > 1).select(*[docs[c] for c in docs.columns]).dropDuplicates([doc_id, text])
    return single.unionByName(several)
