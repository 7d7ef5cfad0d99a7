"""Centroid clustering, byte-level BPE and importance resampling against brute force and on hard rows."""

import base64
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from apexlake.llm import byte_bpe, centroids, importance

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
rng = np.random.default_rng(11)
WORDS = ["".join(rng.choice(list("abcdetéß漢"), rng.integers(1, 7))) for _ in range(200)]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


TEXTS = [
    None, "", " \t\n ", "One", "ONE one oNe", prose(40, 1), prose(40, 1), prose(25, 2), prose(3000, 3), "x" * 5000, "a b " * 40,
    "".join(rng.choice(list("abcdeth"), 3000)), " " * 700 + "end", "=" * 300, "漢" * 400, "It's 12½ we'll 'S <|endoftext|>\x1c\x85 ǅ  \n\n x",
    "tab\tand no-break ​ zero 🙂🙂 é", prose(30, 4) + "\r\n" + "9" * 100,
]
SCHEMA = "doc_id long, text string, token_ids string, n_words string, rank string"  # extra columns named like results


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "t", "n", "r") for i, t in enumerate(TEXTS)] + [(7, TEXTS[7], "t", "n", "r"), (None, prose(30, 9), "t", "n", "r")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


# Byte-level BPE

def test_byte_bpe_equals_the_library(docs, empty, library):
    encoded = byte_bpe.encode(docs, RANKS, PATTERN)
    for row in encoded.collect():
        assert row["token_ids"] == library.encode_ordinary(row["text"] or "")
    for row in byte_bpe.encode_digest(docs, RANKS, PATTERN).collect():
        ids = library.encode_ordinary(row["text"] or "")
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((row["text"] or "").encode()).hexdigest()
    back = byte_bpe.decode(encoded, RANKS)
    assert back.where("decoded <> coalesce(text, '')").count() == 0 and back.columns == [*encoded.columns, "decoded"]
    assert byte_bpe.encode(empty, RANKS, PATTERN).count() == 0 and byte_bpe.encode_digest(empty, RANKS, PATTERN).count() == 0


def test_rows_and_heap_merge_alike(monkeypatch):
    vocabulary = byte_bpe.ByteVocabulary(byte_bpe.read_ranks(RANKS), PATTERN)
    words = ["".join(rng.choice(list("abcdethin "), n)) for n in (*range(1, 70), 100, 200, 256)] + ["a" * n for n in range(1, 40)]
    rows = vocabulary.merge(words)
    assert rows == [vocabulary._merge_long(w.encode()) for w in words]
    monkeypatch.setattr(byte_bpe, "WIDEST", 8)
    assert vocabulary.merge(words) == rows


def test_one_very_long_word(library):
    vocabulary = byte_bpe.ByteVocabulary(byte_bpe.read_ranks(RANKS), PATTERN)
    word = "".join(rng.choice(list("abcdeth"), 100_000))
    ids = np.frombuffer(vocabulary.merge([word])[0], "<u4")
    assert ids.tolist() == library.encode_ordinary(word)


def test_decode_of_odd_ids(spark):
    rows = [(1, None), (2, []), (3, [65, None, 10**6, -5])]
    out = {r["n"]: r["decoded"] for r in byte_bpe.decode(spark.createDataFrame(rows, "n int, token_ids array<int>"), RANKS).collect()}
    vocabulary = byte_bpe.ByteVocabulary(byte_bpe.read_ranks(RANKS), PATTERN)
    assert out[1] is None and bytes(out[2]) == b""
    assert bytes(out[3]) == next(t for t, r in vocabulary.ranks.items() if r == 65)


# Importance resampling

def by_hand(rows, target, percent, least, seed, longest, buckets):
    def features(text):
        lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        runs = [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    own, wanted = [features(t) for _, t in rows], [features(t)[1] for t in target]
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for _, f in own:
        np.add.at(s, f, 1)
    for f in wanted:
        np.add.at(t, f, 1)
    of_s, of_t = s.sum() + buckets, t.sum() + buckets
    gain = [math.floor(1000 * math.log((b + 1) * of_s / ((a + 1) * of_t))) for a, b in zip(s.tolist(), t.tolist())]
    out = []
    for (key, _), (n, f) in zip(rows, own):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append((key, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = [(r[0], r[2], r[3], r[4], k + 1) for k, r in enumerate(order[:len(order) * percent // 100])]
    rest = [(r[0], r[2], r[3], r[4], None) for r in order[len(drawn):]] + [(r[0], r[2], r[3], r[4], None) for r in out if r[1] < least]
    return sorted(map(str, drawn + rest))


@pytest.mark.parametrize("longest, percent", [(1, 10), (1, 55), (3, 100), (2, 0)])
def test_resampling_equals_brute_force(spark, docs, longest, percent):
    target = [prose(50, 1), None, "One two x", prose(10, 77)]
    wanted = spark.createDataFrame([(i, t, "x") for i, t in enumerate(target)], "item_id long, text string, weight string")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = importance.resample(docs, wanted, percent=percent, least_words=5, seed=3, longest=longest, buckets=97)
    assert sorted(str(tuple(r)) for r in got.collect()) == by_hand(rows, target, percent, 5, 3, longest, 97)


def test_resampling_of_level_rows(spark, empty):
    """One id and text on most rows: equal scores beyond any id, cut at an exact count."""
    same = spark.range(300).select(F.lit(5).cast("long").alias("doc_id"), F.lit(prose(30, 5)).alias("text"))
    others = spark.range(100).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), F.lit(prose(30, 6)).alias("text"))
    docs = same.unionByName(others).repartition(5)
    target = empty.select("text")
    for percent in (10, 50, 90, 97):
        got = importance.resample(docs, target, percent=percent, least_words=20, seed=1)
        assert got.count() == 400
        ranks = sorted(r["rank"] for r in got.where("rank IS NOT NULL").collect())
        assert ranks == list(range(1, 4 * percent + 1))
        expected = by_hand([(r["doc_id"], r["text"]) for r in docs.collect()], [], percent, 20, 1, 1, 10_000)
        assert sorted(str(tuple(r)) for r in got.collect()) == expected
    assert importance.resample(empty, target, percent=10, least_words=20, seed=1).count() == 0


def test_least_with(spark):
    values = spark.createDataFrame([(v,) for v in [5, 5, -7, 2**62, None, 5, -2**62]], "v long")
    for wanted, found in [(1, -2**62), (2, -7), (3, 5), (5, 5), (6, 2**62), (7, None)]:
        assert importance.least_with(values, F.col("v"), wanted) == found


# Centroid clustering

def lloyd(rows, k, rounds, dim, scale, seed):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes()))
    centres = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        for j, vs in members.items():
            centres[j] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {}
    for _, c, d in found:
        inertia[c] = inertia.get(c, 0) + d
    return sorted(str((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())) for i, c, d in found)


VECTOR_ROWS = (
    [(i, [float(x) for x in np.round(rng.normal(rng.integers(0, 4), 0.4, 3), 2)]) for i in range(200)]
    + [(200 + i, [0.5, 0.5, 0.5]) for i in range(60)] + [(300 + i, [float(i % 3), float(i % 2), 0.0]) for i in range(60)]
    + [(400, None), (401, []), (402, [1.0, 2.0]), (403, [1.0, None, 2.0]), (404, [1.0, float("nan"), 0.0]), (405, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (5, [9.0, -9.0, 9.0])]
)


@pytest.mark.parametrize("k, rounds, scale", [(1, 2, 256.0), (2, 3, 256.0), (12, 5, 256.0), (25, 4, 1.0), (400, 2, 2.0)])
def test_clusters_equal_lloyd(spark, k, rounds, scale):
    """Also with ties everywhere (scale 1) and more centroids than vectors."""
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in VECTOR_ROWS], "vec_id long, embedding array<double>, vector string, nearest int").repartition(3)
    got = centroids.cluster(df, k, rounds, 3, scale, 2).drop("centroid")
    assert sorted(str(tuple(r)) for r in got.collect()) == lloyd(VECTOR_ROWS, k, rounds, 3, scale, 2)


def test_no_vectors_and_too_large_ones(spark):
    schema = "vec_id long, embedding array<float>"
    assert centroids.cluster(spark.createDataFrame([(1, [1.0])], schema), 4, 2, 3, 1.0, 2).count() == 0
    assert centroids.cluster(spark.createDataFrame([], schema), 4, 2, 3, 1.0, 2).count() == 0
    with pytest.raises(Exception, match="is beyond"):
        centroids.cluster(spark.createDataFrame([(1, [1e30, 0.0, 0.0])], schema), 4, 2, 3, 1.0, 2).count()


def test_bounds_save_distances():
    """The search measures far fewer distances than all, and finds the two nearest centroids."""
    own = np.random.default_rng(1)
    values = own.integers(-200, 200, (40, 8))
    vectors = (values[own.integers(0, 40, 3000)] + own.integers(-12, 12, (3000, 8))).astype(np.int64)
    found = centroids.Centroids(values)
    nearest, second = np.zeros(3000, np.int32), np.ones(3000, np.int32)
    upper, lower = np.full(3000, np.inf), np.zeros(3000)
    first = found.assign(vectors, nearest, second, upper, lower)
    again = found.assign(vectors, nearest, second, upper, lower)
    every = ((vectors[:, None, :] - values[None]) ** 2).sum(axis=2)
    assert (every.argmin(axis=1) == nearest).all()
    searched = lower > 0  # the others lie within half the way to the next centroid
    assert (np.sort(every, axis=1)[:, 1] == every[np.arange(3000), second])[searched].all() and searched.any()
    assert first <= 3000 * 42 and again < 3000 * 2
