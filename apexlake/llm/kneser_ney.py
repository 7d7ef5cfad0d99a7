"""Interpolated modified Kneser-Ney trigram model: counted in Spark, kept as sorted hash arrays, scored by mapped lookups.

Counting takes three passes of partition, shuffle and merge. Tasks reduce their
texts to sorted, compressed columns of (word ids, count), so what is shuffled
are a few large rows, and a word, pair or trigram that fills a third of the
corpus is one entry of each task:

1. words: hash to count, in shards by the leading bits of the hash. A word's
   place in this order is its id.
2. trigrams (u, v, w): in shards by the middle word, and for frequent middle
   words also by u, so that no shard depends on one word. A shard holds all
   trigrams of its contexts (u, v): counts, and for each context its total and
   how many trigrams occur once, twice, and more often.
3. pairs (v, w): how many different u precede them, in shards by the pair;
   from these, per word, the same figures as contexts and as last words.

Each shard of the result is a file of sorted hashes (a directory of leading
bits and the 32 bits after them; a lookup takes a wrong entry for its own about
once in 2^50) with counts beside them. Scoring tasks map these files: lookups
read the pages they touch, and all tasks of a machine share them. The number of
shards grows with the text, so shards and tasks stay equally large.

The files lie in the shared folder, which must be mounted on all workers, as
only mounted files can be mapped. An attempt of a task writes files of its own
and names them in its result, so a task that runs twice does no harm. What is
collected on the driver are names and sums, one row per shard.

Tokens are words (runs without white space, A-Z as lower case) and one end per
text. Words beyond training share one unknown word. A null text is an empty
one and has its end only; rows without an id count as training; repeated rows
count as often as they occur; without any training text every token has
probability one. Other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apexlake.llm.common import mix, pieces, text_bytes, word_hashes, word_spans
from apexlake.session import shared_folder, write_once

SHARD_BYTES = 24 << 20  # of training text for each shard
HELD_TOKENS = 3_000_000  # tokens a task collects before it merges and sends them on
END = np.uint64(0x9D5C0FB2E1A3C477)  # fixed value: the hash of the end token
_K = np.uint64(0xD6E8FEB86659FD93)


MOST_WORDS = (1 << 32) - 16  # distinct words: their ids, and some of the model's own, have 32 bits


def checked_words(count: int) -> int:
    """The number of distinct words, if ids can tell them apart: beyond that scores would be wrong without a sign."""
    if count > MOST_WORDS:
        raise OverflowError(f"{count} distinct words, but word ids have 32 bits: train on fewer texts or cut rare words first")
    return count


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64))


def triple_hash(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return mix(pair_hash(a, b) + c.astype(np.uint64) * _K)


def pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length as one compressed value, byte by byte of equal weight."""
    planes = [c.view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in map(np.ascontiguousarray, columns)]
    return len(columns[0]).to_bytes(8, "little") + pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpack(value: bytes, *kinds: type) -> list[np.ndarray]:
    n, sizes = int.from_bytes(value[:8], "little"), [np.dtype(k).itemsize for k in kinds]
    raw = np.frombuffer(pa.decompress(value[8:], decompressed_size=n * sum(sizes), codec="zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for kind, size in zip(kinds, sizes):
        out.append(np.ascontiguousarray(raw[at:at + n * size].reshape(size, n).T).reshape(-1).view(kind))
        at += n * size
    return out


def unpack_all(values, *kinds: type) -> list[np.ndarray]:
    parts = [unpack(v, *kinds) for v in values]
    return [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, kind) for k, kind in enumerate(kinds)]


def runs(sorted_: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.concatenate([[0], np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1]) if len(sorted_) else np.zeros(0, np.int64)


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else values[:0]


def save(folder: str, name: str, values: np.ndarray) -> str:
    path = f"{folder}/{name}-{uuid.uuid4().hex}.npy"
    np.save(path, values)
    return path


@lru_cache(maxsize=100_000)
def mapped(path: str) -> np.ndarray:
    return np.load(path, mmap_mode="r")


def narrow(values: np.ndarray) -> np.ndarray:
    """The same counts in the smallest unsigned type that holds them."""
    top = int(values.max(initial=0))
    return values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


@dataclass
class Table:
    """Paths of a sorted hash array: directory, bits after it, and where the caller finds the values."""

    directory: str
    bits: str
    values: list[str]

    @staticmethod
    def save(folder: str, name: str, hashes: np.ndarray, values: list[np.ndarray]) -> list[str]:
        """Write an array of distinct sorted hashes; returns the paths."""
        lead = max(1, (len(hashes) // 4).bit_length())
        top = (hashes >> np.uint64(64 - lead)).astype(np.int64)
        directory = np.searchsorted(top, np.arange((1 << lead) + 1)).astype(np.uint32)
        after = (hashes << np.uint64(lead) >> np.uint64(32)).astype(np.uint32)
        return [save(folder, f"{name}-directory", directory), save(folder, f"{name}-bits", after)] + [
            save(folder, f"{name}-values", v) for v in values]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        directory, bits = mapped(self.directory), mapped(self.bits)
        lead = (len(directory) - 1).bit_length() - 1
        top = (hashes >> np.uint64(64 - lead)).astype(np.int64)
        wanted = (hashes << np.uint64(lead) >> np.uint64(32)).astype(np.uint32)
        at, end = directory[top].astype(np.int64), directory[top + 1].astype(np.int64)
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.flatnonzero(at < end)
        while len(open_):
            place = at[open_]
            here = bits[place]
            same = here == wanted[open_]
            out[open_[same]] = place[same]
            at[open_] += 1
            open_ = open_[(here < wanted[open_]) & (at[open_] < end[open_])]
        return out

    def take(self, places: np.ndarray, k: int = 0) -> np.ndarray:
        """Values at places; 0 where there is none."""
        values = mapped(self.values[k])
        out = np.zeros(len(places), np.int64)
        known = places >= 0
        out[known] = values[places[known]]
        return out


def discounts(n: np.ndarray) -> tuple[float, float, float]:
    """D1, D2, D3+ from how many n-grams have count 1 to 4, held within 0 and the count they apply to."""
    n1, n2, n3, n4 = map(float, n)
    if not n1 or not n2:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.0), float(k + 1)) for k, d in enumerate(found))  # type: ignore[return-value]


def spectrum(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


@dataclass
class Model:
    """File names and sums; what grows with the vocabulary stays in the files."""

    n_shards: int
    train_tokens: int = 0
    n_texts: int = 0
    words: list[list[str]] = field(default_factory=list)  # per shard: hashes, counts, then figures as last word and context
    first_id: list[int] = field(default_factory=list)
    begin: tuple[int, int, int, int] = (0, 0, 0, 0)  # total, once, twice, more often: the begin of a text as a context
    triples: list[list[str]] = field(default_factory=list)
    contexts: list[list[str]] = field(default_factory=list)
    pairs: list[list[str]] = field(default_factory=list)
    n_pairs: int = 0
    d1: tuple[float, float, float] = (0.5, 1.0, 1.5)
    d2: tuple[float, float, float] = (0.5, 1.0, 1.5)
    d3: tuple[float, float, float] = (0.5, 1.0, 1.5)
    once_or_more: tuple[int, int, int] = (0, 0, 0)  # words after one, two, more different words

    @property
    def vocabulary(self) -> int:
        return self.first_id[-1] if self.first_id else 0

    @property
    def lead(self) -> int:
        return self.n_shards.bit_length() - 1


class Tokens:
    """The tokens of an array of texts, as ids: end of text included, begin of text as a context."""

    def __init__(self, texts: pa.Array, model: Model, figures: bool):
        data, offsets = text_bytes(texts)
        starts, ends, before = word_spans(data, offsets)
        sizes = np.diff(before) + 1
        self.last = np.cumsum(sizes) - 1
        self.first = self.last - sizes + 1
        hashes = np.full(int(sizes.sum()), END, np.uint64)
        is_word = np.ones(len(hashes), bool)
        is_word[self.last] = False
        hashes[is_word] = word_hashes(data, starts, ends)
        unique, self.of = np.unique(hashes, return_inverse=True)
        self.unknown = model.vocabulary + 1
        self.ids = np.full(len(unique), self.unknown, np.int64)
        self.figures = np.zeros((6, len(unique)), np.int64)  # count, as last word, then total, once, twice, more as context
        cuts = np.searchsorted(unique >> np.uint64(64 - model.lead) if model.lead else np.zeros(len(unique), np.uint64), np.arange(model.n_shards + 1))
        for shard, (s, e) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if s == e or shard >= len(model.words):
                continue
            own = mapped(model.words[shard][0])
            if not len(own):
                continue
            place = np.minimum(np.searchsorted(own, unique[s:e]), len(own) - 1)
            known = own[place] == unique[s:e]
            self.ids[s:e][known] = place[known] + model.first_id[shard]
            for k, path in enumerate(model.words[shard][1:] if figures else model.words[shard][1:2]):
                self.figures[k, s:e][known] = mapped(path)[place[known]]

    def contexts(self, begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``u, v, w`` for every token."""
        w = self.ids[self.of]
        v = np.empty_like(w)
        v[1:] = w[:-1]
        v[self.first] = begin
        u = np.empty_like(w)
        u[1:] = v[:-1]
        u[self.first] = begin
        return u, v, w


def _parts(count_of_v: np.ndarray, model: Model) -> np.ndarray:
    """Over how many shards the trigrams with a middle word are dealt: one for each shard's worth of it."""
    return np.maximum(1, -(-count_of_v * model.n_shards // max(1, model.train_tokens)))


def _shard_of(u: np.ndarray, v: np.ndarray, parts: np.ndarray, model: Model) -> np.ndarray:
    part = mix(u.astype(np.uint64)) % parts.astype(np.uint64)
    return (mix(v.astype(np.uint64) * _K + part) % np.uint64(model.n_shards)).astype(np.int64)


def _count_of_middle(tokens: Tokens, v: np.ndarray, begin: int, n_texts: int) -> np.ndarray:
    """Training count of each token's predecessor."""
    own = tokens.figures[0][tokens.of]
    out = np.empty_like(own)
    out[1:] = own[:-1]
    out[tokens.first] = n_texts
    return out


def _by_shard(shards: np.ndarray, n_shards: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(shards.astype(np.uint16 if n_shards <= 1 << 16 else np.uint32), kind="stable")
    return order, np.searchsorted(shards[order], np.arange(n_shards + 1))


def _rows(shards: list[int], chunks: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(chunks, pa.binary())], names=["shard", "chunk"])


CHUNKS = "shard int, chunk binary"


def _word_chunks(model: Model):
    def send(held: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        hashes, n = _summed(np.concatenate(held), np.concatenate(counts))
        cuts = np.searchsorted(hashes >> np.uint64(64 - model.lead), np.arange(model.n_shards + 1)) if model.lead else [0, len(hashes)]
        full = [(k, s, e) for k, (s, e) in enumerate(zip(cuts[:-1], cuts[1:])) if e > s]
        return _rows([k for k, _, _ in full], [pack(hashes[s:e], n[s:e].astype(np.uint32)) for _, s, e in full])

    def run(batches) -> Iterator[pa.RecordBatch]:
        held, counts = [], []
        for batch in batches:
            for piece in pieces(batch, "text"):
                data, offsets = text_bytes(piece.column("text"))
                starts, ends, _ = word_spans(data, offsets)
                found, n = np.unique(word_hashes(data, starts, ends), return_counts=True)
                held += [found, np.array([END])]
                counts += [n, np.array([len(piece)])]
                if sum(map(len, held)) > HELD_TOKENS:
                    hashes, n = _summed(np.concatenate(held), np.concatenate(counts))
                    held, counts = [hashes], [n]
                    if len(hashes) > HELD_TOKENS // 2:
                        yield send(held, counts)
                        held, counts = [], []
        if held:
            yield send(held, counts)

    return run


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys with the sums of their counts."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    starts = runs(keys)
    return keys[starts], sums(counts, starts)


def _merge_words(folder: str):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        hashes, counts = unpack_all(group["chunk"], np.uint64, np.uint32)
        hashes, counts = _summed(hashes, counts.astype(np.int64))
        paths = [save(folder, "words", hashes), save(folder, "counts", narrow(counts))]
        return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "n": [len(hashes)], "total": [int(counts.sum())], "paths": [paths]})

    return run


def _triple_chunks(model: Model):
    begin = model.vocabulary

    def send(held: list[tuple]) -> pa.RecordBatch:
        u, v, w, parts = (np.concatenate(c) for c in zip(*held))
        last = v.astype(np.uint64) << np.uint64(32) | w.astype(np.uint64)
        order = np.lexsort((u, last))
        u, v, w, parts, last = u[order], v[order], w[order], parts[order], last[order]
        fresh = np.ones(len(u), bool)
        fresh[1:] = (last[1:] != last[:-1]) | (u[1:] != u[:-1])
        starts = np.flatnonzero(fresh)
        counts = np.diff(np.append(starts, len(u)))
        u, v, w, parts = u[starts], v[starts], w[starts], parts[starts]
        order, cuts = _by_shard(_shard_of(u, v, parts, model), model.n_shards)
        shards, chunks = [], []
        for k, (s, e) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if e > s:
                own = order[s:e]
                step = np.diff(v[own], prepend=0)
                shards.append(k)
                chunks.append(pack(u[own].astype(np.uint32), step.astype(np.uint32), w[own].astype(np.uint32), counts[own].astype(np.uint32)))
        return _rows(shards, chunks)

    def run(batches) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                tokens = Tokens(piece.column("text"), model, figures=False)
                u, v, w = tokens.contexts(begin)
                parts = _parts(_count_of_middle(tokens, v, begin, model.n_texts), model)
                held.append((u.astype(np.uint32), v.astype(np.uint32), w.astype(np.uint32), parts.astype(np.uint32)))
                size += len(u)
                if size > HELD_TOKENS:
                    yield send(held)
                    held, size = [], 0
        if held:
            yield send(held)

    return run


_MERGED = "shard int, chunk binary, paths array<string>, spectrum array<bigint>"


def _merged(shard: int | None, chunk: bytes | None, paths: list[str] | None, found: list[int] | None) -> dict:
    return {"shard": shard, "chunk": chunk, "paths": paths, "spectrum": found}


def _groups(starts: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Total, and how many counts are one, two, more, in each group."""
    return [sums(counts, starts), *[sums(x.astype(np.int64), starts) for x in (counts == 1, counts == 2, counts > 2)]]


def _merge_triples(folder: str, n_shards: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        shard = int(group["shard"].iloc[0])
        parts = [unpack(c, np.uint32, np.uint32, np.uint32, np.uint32) for c in group["chunk"]]
        u, w, n = (np.concatenate([p[k] for p in parts]) for k in (0, 2, 3))
        v = np.concatenate([np.cumsum(p[1], dtype=np.uint64).astype(np.uint32) for p in parts])
        del parts
        hashes = triple_hash(u, v, w)
        order = np.argsort(hashes)
        hashes = hashes[order]
        starts = runs(hashes)
        counts = sums(n[order].astype(np.int64), starts)
        first = order[starts]
        u, v, w = u[first], v[first], w[first]
        paths = Table.save(folder, "triples", hashes[starts], [narrow(counts)])
        del hashes, order, first, n

        context = pair_hash(u, v)
        order = np.argsort(context)
        starts = runs(context[order])
        figures = np.stack(_groups(starts, counts[order]), axis=1)
        kinds, code = np.unique(figures, axis=0, return_inverse=True)  # most contexts share a few figures
        paths += Table.save(folder, "contexts", context[order][starts], [narrow(code.reshape(-1)), kinds])
        del context, order, figures

        last = np.sort(v.astype(np.uint64) << np.uint64(32) | w.astype(np.uint64))
        starts = runs(last)
        before = np.diff(np.append(starts, len(last))).astype(np.uint32)
        last = last[starts]
        rows = [_merged(shard, None, paths, spectrum(counts))]
        order, cuts = _by_shard((mix(last) % np.uint64(n_shards)).astype(np.int64), n_shards)
        for k, (s, e) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if e > s:
                own = last[order[s:e]]
                rows.append(_merged(k, pack(np.diff(own >> np.uint64(32), prepend=np.uint64(0)).astype(np.uint32), own.astype(np.uint32), before[order[s:e]]), None, None))
        return pd.DataFrame(rows, columns=["shard", "chunk", "paths", "spectrum"])

    return run


def _merge_pairs(folder: str, first_id: list[int]):
    edges = np.array(first_id, np.int64)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(c, np.uint32, np.uint32, np.uint32) for c in group["chunk"]]
        last = np.concatenate([np.cumsum(p[0], dtype=np.uint64) << np.uint64(32) | p[1].astype(np.uint64) for p in parts])
        last, counts = _summed(last, np.concatenate([p[2] for p in parts]).astype(np.int64))
        v, w = last >> np.uint64(32), last & np.uint64(0xFFFFFFFF)
        hashes = mix(last)
        order = np.argsort(hashes)
        paths = Table.save(folder, "pairs", hashes[order], [narrow(counts[order])])
        rows = [_merged(int(group["shard"].iloc[0]), None, paths, [*spectrum(counts), len(last)])]
        starts = runs(v)
        as_context = [v[starts].astype(np.int64), *_groups(starts, counts)]
        words, ones = _summed(w, np.ones(len(w), np.int64))
        as_last = [words.astype(np.int64), ones, *[np.zeros_like(ones)] * 3]
        # Column 1 of a context row is its total; of a last-word row the number of pairs. A flag tells them apart.
        ids = np.concatenate([as_context[0], as_last[0]])
        flag = np.concatenate([np.ones(len(starts), np.uint8), np.zeros(len(words), np.uint8)])
        figures = [np.concatenate([a, b]).astype(np.uint32) for a, b in zip(as_context[1:], as_last[1:])]
        shard = np.searchsorted(edges, ids, "right") - 1
        order, cuts = _by_shard(shard, len(edges))
        for k, (s, e) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if e > s:
                own = order[s:e]
                rows.append(_merged(k, pack((ids[own] - edges[k]).astype(np.uint32), flag[own], *[f[own] for f in figures]), None, None))
        return pd.DataFrame(rows, columns=["shard", "chunk", "paths", "spectrum"])

    return run


def _merge_figures(folder: str, first_id: list[int]):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        shard = int(group["shard"].iloc[0])
        ids, flag, *figures = unpack_all(group["chunk"], np.uint32, np.uint8, *[np.uint32] * 4)
        size = first_id[shard + 1] - first_id[shard] if shard + 1 < len(first_id) else 1
        out = np.zeros((5, size), np.int64)
        np.add.at(out[0], ids[flag == 0], figures[0][flag == 0])
        for k in range(4):
            np.add.at(out[k + 1], ids[flag == 1], figures[k][flag == 1])
        paths = [save(folder, "figures", narrow(row)) for row in out]
        found = [*spectrum(out[0]), int((out[0] > 2).sum()), *(out[1:, 0].tolist() if size else [0] * 4)]
        return pd.DataFrame([_merged(shard, None, paths, found)], columns=["shard", "chunk", "paths", "spectrum"])

    return run


def _mounted(folder: str) -> str:
    address = urlparse(folder)
    if address.scheme not in ("", "file"):
        raise ValueError(f"{folder}: the shared folder must be mounted on the workers, so that model files can be mapped")
    return address.path


def train(docs: DataFrame, text: str = "text") -> Model:
    """Count a model over all texts of ``docs``."""
    spark = docs.sparkSession
    source = docs.select(F.col(text).alias("text"))
    folder = f"{_mounted(shared_folder(spark))}/model-{uuid.uuid4().hex}"
    Path(folder).mkdir(parents=True)
    size, n_texts = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    model = Model(1 << max(0, (int(size) // SHARD_BYTES).bit_length()), n_texts=int(n_texts))
    if not n_texts:
        return model

    words = source.mapInArrow(_word_chunks(model), CHUNKS).groupBy("shard").applyInPandas(
        _merge_words(folder), "shard int, n bigint, total bigint, paths array<string>")
    found = {row["shard"]: row for row in words.collect()}  # one row per shard
    model.first_id = [0]
    for shard in range(model.n_shards):
        row = found.get(shard)
        model.words.append(list(row["paths"]) if row else [save(folder, "words", np.zeros(0, np.uint64)), save(folder, "counts", np.zeros(0, np.uint8))])
        model.first_id.append(checked_words(model.first_id[-1] + (row["n"] if row else 0)))
        model.train_tokens += row["total"] if row else 0

    def merged(chunks: DataFrame, merge, label: str) -> tuple[DataFrame, dict, np.ndarray]:
        """Merge by shard: the chunks it sends on, file names by shard, and the sums of its spectra."""
        out = write_once(chunks.groupBy("shard").applyInPandas(merge, _MERGED), label)
        done = out.where("paths IS NOT NULL").select("shard", "paths", "spectrum").collect()  # one row per shard
        return out.where("paths IS NULL").select("shard", "chunk"), {row["shard"]: row for row in done}, np.sum([row["spectrum"] for row in done], axis=0)

    chunks = source.mapInArrow(_triple_chunks(model), CHUNKS)
    pair_chunks, found, total = merged(chunks, _merge_triples(folder, model.n_shards), "model-triples")
    model.d3 = discounts(total)
    paths = [found[k]["paths"] if k in found else None for k in range(model.n_shards)]
    model.triples, model.contexts = [p and p[:3] for p in paths], [p and p[3:] for p in paths]

    figure_chunks, found, total = merged(pair_chunks, _merge_pairs(folder, model.first_id), "model-pairs")
    model.d2, model.n_pairs = discounts(total[:4]), int(total[4])
    model.pairs = [found[k]["paths"] if k in found else None for k in range(model.n_shards)]

    _, found, total = merged(figure_chunks, _merge_figures(folder, model.first_id), "model-figures")
    model.d1, model.once_or_more = discounts(total[:4]), (int(total[0]), int(total[1]), int(total[4]))
    for shard in range(model.n_shards):
        size = model.first_id[shard + 1] - model.first_id[shard]
        model.words[shard] += found[shard]["paths"] if shard in found else [save(folder, "figures", np.zeros(size, np.uint8)) for _ in range(5)]
    model.begin = tuple(found[model.n_shards]["spectrum"][5:])
    return model


def _discounted(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(counts - np.array([0.0, *d])[np.minimum(counts, 3)], 0.0)


def _left_over(figures: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    """The share that discounts take from a context and give to the lower order; 1 for a context never seen."""
    return np.where(figures[0] > 0, (figures[1] * d[0] + figures[2] * d[1] + figures[3] * d[2]) / np.maximum(figures[0], 1), 1.0)


def _look_up(tables: list, shards: np.ndarray, n_shards: int, hashes: np.ndarray, width: int, values) -> np.ndarray:
    """Values of hashes over all shards of a table; zeros where there is none."""
    out = np.zeros((width, len(hashes)), np.int64)
    order, cuts = _by_shard(shards, n_shards)
    for paths, s, e in zip(tables, cuts[:-1].tolist(), cuts[1:].tolist()):
        if e > s and paths:
            own = order[s:e]
            table = Table(paths[0], paths[1], paths[2:])
            out[:, own] = values(table, table.find(hashes[own]))
    return out


def token_log_probabilities(model: Model, texts: pa.Array) -> tuple[Tokens, np.ndarray, np.ndarray]:
    """The tokens, and each one's training count and log10 probability given the two before it."""
    tokens, begin = Tokens(texts, model, figures=True), model.vocabulary
    u, v, w = tokens.contexts(begin)
    count, as_last = tokens.figures[0][tokens.of], tokens.figures[1][tokens.of]
    even = 1.0 / (model.vocabulary + 1)
    once = np.array([model.n_pairs, *model.once_or_more], float)[:, None]
    p = _discounted(as_last, model.d1) / max(1, model.n_pairs) + _left_over(once, model.d1) * even

    own = tokens.figures[2:][:, tokens.of]
    context = np.empty_like(own)
    context[:, 1:] = own[:, :-1]
    context[:, tokens.first] = np.array(model.begin)[:, None]
    hashes = pair_hash(v, w)
    pairs = _look_up(model.pairs, (hashes % np.uint64(model.n_shards)).astype(np.int64), model.n_shards, hashes, 1,
                     lambda t, places: t.take(places)[None])[0]
    p = _discounted(pairs, model.d2) / np.maximum(context[0], 1) + _left_over(context, model.d2) * p

    shards = _shard_of(u, v, _parts(_count_of_middle(tokens, v, begin, model.n_texts), model), model)

    def figures(table: Table, places: np.ndarray) -> np.ndarray:
        kinds = np.vstack([mapped(table.values[1]), np.zeros((1, 4), np.int64)])
        return kinds[np.where(places >= 0, table.take(places), len(kinds) - 1)].T

    context = _look_up(model.contexts, shards, model.n_shards, pair_hash(u, v), 4, figures)
    triples = _look_up(model.triples, shards, model.n_shards, triple_hash(u, v, w), 1, lambda t, places: t.take(places)[None])[0]
    p = _discounted(triples, model.d3) / np.maximum(context[0], 1) + _left_over(context, model.d3) * p
    return tokens, count, np.log10(p)


def score(model: Model, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity`` for every text.

    ``base_score`` adds up smoothed unigram logarithms, ``score`` the model's
    log10 probabilities; perplexity is ten to the minus score per token.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # names and sums
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        model = sent.value
        base = model.train_tokens + 0.5 * (model.vocabulary + 1)
        for batch in batches:
            for piece in pieces(batch, "text"):
                tokens, count, logs = token_log_probabilities(model, piece.column("text"))
                sizes = tokens.last - tokens.first + 1
                known = np.add.reduceat((count > 0).astype(np.int64), tokens.first)
                plain = np.add.reduceat(np.log10((count + 0.5) / base), tokens.first)
                total = np.add.reduceat(logs, tokens.first)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), *map(pa.array, (sizes, known, plain, total, 10.0 ** (-total / sizes)))],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score", "perplexity"])

    kind = source.schema["doc_id"].dataType.simpleString()
    scored = source.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double, perplexity double")
    return scored.withColumn("train_tokens", F.lit(model.train_tokens).cast("bigint"))
