"""K-means over integer vectors with the Shallot search, exact to the last tie.

Each vector remembers its nearest and its second-nearest centroid, an upper
bound of its distance to the first and a lower bound of that to all others.
When the centroids have moved,

* a vector whose bounds still part, or that lies within half the way to the
  next centroid, is done without a distance;
* the others measure both remembered centroids and start from the closer one:
  its neighbours are taken in order of their distance from it, up to the
  distance to it plus that to the second-nearest centroid so far. This ball
  shrinks with every closer centroid found;
* what lies in the ball is compared by squared distances in 64-bit integers, so
  rounding decides nothing: of two centroids at one distance the one with the
  smaller number wins.

Bounds are doubles. They only skip work, with a margin far above their rounding.

Vectors and bounds are a written table of one row per vector. A round reads
it, writes the next one and removes the one before; a lost executor costs part
of a round. A round's centroids come from sums per task and centroid: at most
``k`` rows a task are shuffled, and ``k`` times the dimension comes to the driver,
whatever the number of vectors. Nothing is grouped by a vector or its cluster.

Results: vectors of another length, null ones, and those with a null or
non-finite component are left out. A null id is an id like any other. Repeated
rows are vectors of their own in the same cluster. Fewer vectors than ``k`` give
fewer centroids, an empty table gives none and no rows. Extra columns are not
returned. A component beyond 2**27 in size after scaling would overflow the
distance: it ends the job with an error that says so.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apexlake.session import remove, shared_folder

MOST = 1 << 27
MARGIN = 1e-9
STATE = "vec_id long, vector binary, nearest int, second int, upper double, lower double"
NAMES = ["vec_id", "vector", "nearest", "second", "upper", "lower"]


def _squared(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances, row by row, of 64-bit integers."""
    difference = vectors - centres
    return np.einsum("ij,ij->i", difference, difference)


class Centroids:
    """The centroids of a round, each with the others in order of their distance from it."""

    def __init__(self, values: np.ndarray):
        self.values = values
        count = len(values)
        gaps = np.array([_squared(values, values[i]) for i in range(count)]).reshape(count, count)
        self.gap = np.sqrt(gaps.astype(np.float64))
        gaps[np.arange(count), np.arange(count)] = -1
        self.neighbours = np.argsort(gaps, axis=1, kind="stable")[:, 1:]
        own = np.arange(count)
        self.half = self.gap[own, self.neighbours[:, 0]] / 2 if count > 1 else np.full(count, np.inf)

    def moved_to(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How far each centroid moves, and the farthest that any of the others does."""
        moves = np.sqrt(_squared(values, self.values).astype(np.float64))
        others = np.array([np.delete(moves, i).max(initial=0.0) for i in range(len(moves))])
        return moves, others

    def assign(self, vectors: np.ndarray, nearest, second, upper, lower) -> int:
        """Bring nearest and second-nearest centroid and the bounds up to date, in place; returns the distances measured."""
        def unsure(rows):
            return upper[rows] * (1 + MARGIN) + MARGIN >= np.maximum(lower[rows], self.half[nearest[rows]])

        rows = np.arange(len(vectors))
        rows = rows[unsure(rows)]
        to_first = _squared(vectors[rows], self.values[nearest[rows]])
        measured = len(rows)
        upper[rows] = np.sqrt(to_first)
        still = unsure(rows)
        rows, to_first = rows[still], to_first[still]
        if not len(rows) or len(self.values) == 1:
            return measured
        own = vectors[rows]
        a, b = nearest[rows], second[rows]
        to_second = _squared(own, self.values[b])
        measured += len(rows)
        swap = (to_second < to_first) | ((to_second == to_first) & (b < a))
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        to_first, to_second = np.where(swap, to_second, to_first), np.where(swap, to_first, to_second)
        start, from_start = a.copy(), np.sqrt(to_first)
        for s in np.unique(start):
            live = np.flatnonzero(start == s)
            for j in self.neighbours[s]:
                ball = from_start[live] + np.sqrt(to_second[live])
                live = live[ball * (1 + MARGIN) + MARGIN >= self.gap[s, j]]
                if not len(live):
                    break
                asked = live[b[live] != j]
                found = _squared(own[asked], self.values[j])
                measured += len(asked)
                first = (found < to_first[asked]) | ((found == to_first[asked]) & (j < a[asked]))
                at = asked[first]
                b[at], to_second[at] = a[at], to_first[at]
                a[at], to_first[at] = j, found[first]
                next_ = ~first & ((found < to_second[asked]) | ((found == to_second[asked]) & (j < b[asked])))
                at = asked[next_]
                b[at], to_second[at] = j, found[next_]
        nearest[rows], second[rows] = a, b
        upper[rows], lower[rows] = np.sqrt(to_first), np.sqrt(to_second)
        return measured


def _vectors(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    raw = b"".join(batch.column("vector").to_pylist())
    return np.frombuffer(raw, "<i4").reshape(-1, dim).astype(np.int64)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).copy()


def _packed(df: DataFrame, id_column: str, vector: str, dim: int, scale: float) -> DataFrame:
    """Kept vectors as integers, in the state before the first round: nothing is known of them."""
    values = F.col(vector)
    whole = (F.size(values) == dim) & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # The largest component tells an overflow before numbers are cut to 32 bits.
    doubles = F.transform(values, lambda x: F.floor(x.cast("double") * scale))
    largest = F.array_max(F.transform(values, lambda x: F.abs(x.cast("double"))))
    checked = F.when(largest * scale < MOST, doubles).otherwise(F.raise_error(F.lit(f"a component times {scale} is beyond {MOST}")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            rows = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(n, dim)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), pa.array([r.tobytes() for r in rows], pa.binary()),
                pa.array(np.zeros(n, np.int32)), pa.array(np.ones(n, np.int32)),
                pa.array(np.full(n, np.inf)), pa.array(np.zeros(n)),
            ], names=NAMES)

    kept = df.where(F.coalesce(whole, F.lit(False)))
    return kept.select(F.col(id_column).cast("long").alias("vec_id"), checked.alias("v")).mapInArrow(run, STATE)


def _assigned(state: DataFrame, centroids: Centroids, moved, dim: int) -> DataFrame:
    sent = state.sparkSession.sparkContext.broadcast((centroids, moved))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, moved = sent.value
        for batch in batches:
            nearest, second, upper, lower = (_column(batch, name) for name in NAMES[2:])
            if moved is not None:
                upper += moved[0][nearest]
                lower -= moved[1][nearest]
            centroids.assign(_vectors(batch, dim), nearest, second, upper, lower)
            arrays = [batch.column("vec_id"), batch.column("vector"), *map(pa.array, (nearest, second, upper, lower))]
            yield pa.RecordBatch.from_arrays(arrays, names=NAMES)

    return state.mapInArrow(run, STATE)


def _sums(state: DataFrame, k: int, dim: int) -> dict[int, tuple[int, list[int]]]:
    """Vectors of each centroid: how many, and the sum of each component. ``k`` rows at most reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            nearest, vectors = _column(batch, "nearest"), _vectors(batch, dim)
            order = np.argsort(nearest, kind="stable")
            found, starts = np.unique(nearest[order], return_index=True)
            if len(found):
                total[found] += np.add.reduceat(vectors[order], starts, axis=0)
                count += np.bincount(nearest, minlength=k)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([
            pa.array(used.astype(np.int32)), pa.array(count[used]), pa.array(list(total[used]), pa.list_(pa.int64())),
        ], names=["nearest", "n", "total"])

    partial = state.select("nearest", "vector").mapInArrow(run, "nearest int, n long, total array<long>")
    totals = [F.sum(F.get("total", F.lit(i))) for i in range(dim)]
    summed = partial.groupBy("nearest").agg(F.sum("n").alias("n"), F.array(*totals).alias("total"))
    return {row["nearest"]: (row["n"], row["total"]) for row in summed.collect()}


def _next(centroids: Centroids, sums: dict[int, tuple[int, list[int]]]) -> np.ndarray:
    values = centroids.values.copy()
    for c, (n, total) in sums.items():
        values[c] = [x // n for x in total]
    return values


def _write(df: DataFrame) -> tuple[DataFrame, str]:
    path = f"{shared_folder(df.sparkSession)}/written/centroids-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def cluster(
    df: DataFrame, k: int, rounds: int, dim: int, scale: float, seed: int,
    id_column: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """``vec_id, cluster, distance`` of each kept vector, with its cluster's and all clusters' inertia and its centroid.

    ``scale`` times a component is rounded down to an integer. The first
    centroids are the ``k`` vectors with the smallest SHA-256 of ``seed:id``.
    Each of ``rounds`` rounds assigns all vectors and moves every centroid that
    has some to their rounded-down mean; then they are assigned once more.
    """
    spark = df.sparkSession
    state, path = _write(_packed(df, id_column, vector, dim, scale))
    chosen = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = state.select(chosen.alias("h"), "vec_id", "vector").orderBy("h", "vec_id", "vector").limit(k).collect()
    columns = ["vec_id", F.col("nearest").alias("cluster")]
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>"
    if not first:
        return spark.createDataFrame([], out)
    centroids = Centroids(np.array([np.frombuffer(row["vector"], "<i4") for row in first]).astype(np.int64))
    moved = None
    for _ in range(rounds):
        after, written = _write(_assigned(state, centroids, moved, dim))
        remove(spark, path)
        state, path = after, written
        values = _next(centroids, _sums(state, len(first), dim))
        moved, centroids = centroids.moved_to(values), Centroids(values)
    last, written = _write(_assigned(state, centroids, moved, dim))
    remove(spark, path)
    sent = spark.sparkContext.broadcast(centroids.values)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distance = _squared(_vectors(batch, dim), sent.value[_column(batch, "cluster")])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("cluster"), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    measured, _ = _write(last.select(*columns, "vector").mapInArrow(measure, "vec_id long, cluster int, distance long"))
    remove(spark, written)
    inertia = dict(measured.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    total = int(sum(inertia.values()))
    known = [  # one row per centroid
        (c, int(inertia[c]), total, hashlib.sha256(",".join(map(str, values)).encode()).hexdigest(), values)
        for c, values in enumerate(centroids.values.tolist()) if c in inertia
    ]
    looked_up = spark.createDataFrame(
        known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>")
    return measured.join(F.broadcast(looked_up), "cluster").select(*[part.split(" ")[0] for part in out.split(", ")])
