"""Centroid clustering in whole numbers, with the threshold algorithm for nearest centroids.

For each dimension the centroids are listed in order of their component. A vector walks every
list outward from its own component, in each step to the nearest centroid not yet met there
(Fagin, Lotem, Naor, 2001). A centroid met for the first time is compared in full. One that no
list has met yet is at least as far away in each dimension as the list's frontier, so when the
squared frontier distances sum up to strictly more than the best exact distance, no other
centroid can be as near, and ties are settled: the smaller number wins. All vectors of a batch
walk together in numpy; those that have stopped leave.

Spark deals the vectors over tasks. A round broadcasts the centroids (`k` times the number of
components, both parameters), each task returns a row per cluster with its exact sums, and the
sums of all tasks are added as decimals: at most k rows of one vector's width reach the driver.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelarder.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

K, ROUNDS, WIDTH, SCALE, SEED = 40, 5, 64, 256, 2
_CHUNK = 2048  # vectors that walk together
_FAST = 1 << 20  # below this, squared distances of up to 2,048 components are exact in doubles
_MOST = (1 << 63) - 1
_EDGE = 1 << 96  # components beyond it count as it, so that sums fit into 38 digits


def whole_components(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) exactly, in doubles, or Python numbers up to 2**96 where some are large."""
    with np.errstate(over="ignore"):
        scaled = np.floor(x * float(scale))
    if not scaled.size or np.abs(scaled).max() < _FAST:
        return scaled
    exact = [int(max(-_EDGE, min(v, _EDGE))) for v in scaled.ravel().tolist()]
    return np.array(exact, object).reshape(x.shape)


def _whole(x: np.ndarray) -> np.ndarray:
    """Python numbers."""
    return x if x.dtype == object else np.array([int(v) for v in x.ravel().tolist()], object).reshape(x.shape)


class Lists:
    """The centroids of each dimension in order: `value` and `number`, with a gap at both ends."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.number = np.argsort(centroids, axis=0, kind="stable")
        self.value = np.take_along_axis(centroids, self.number, axis=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each vector and its squared distance."""
        n, (k, width) = len(vectors), self.centroids.shape
        best, distance = np.full(n, -1, np.int64), np.zeros(n, vectors.dtype)
        # Frontiers: the next centroid downwards is at `low`, the next upwards at `high`.
        high = np.empty((n, width), np.int64)
        for d in range(width):
            high[:, d] = np.searchsorted(self.value[:, d], vectors[:, d])
        low = high - 1
        met = np.zeros((n, k), bool)
        walking, dims = np.arange(n), np.arange(width)[None, :]
        while len(walking):
            x, lo, hi = vectors[walking], low[walking], high[walking]
            down = x - self.value[np.maximum(lo, 0), dims]
            up = self.value[np.minimum(hi, k - 1), dims] - x
            downwards = (hi >= k) | ((lo >= 0) & (down <= up))
            frontier = np.where(downwards, down, up)
            bound = (frontier * frontier).sum(axis=1)
            stop = met[walking].all(axis=1) | ((best[walking] >= 0) & (bound > distance[walking]))
            go = ~stop
            walking, downwards, lo, hi = walking[go], downwards[go], lo[go], hi[go]
            if not len(walking):
                break
            number = self.number[np.where(downwards, lo, hi), dims]
            low[walking], high[walking] = lo - downwards, hi + ~downwards
            now = np.zeros((len(walking), k), bool)
            now[np.arange(len(walking))[:, None], number] = True
            now &= ~met[walking]
            met[walking] |= now
            for c in np.flatnonzero(now.any(axis=0)).tolist():
                rows = walking[now[:, c]]
                gap = vectors[rows] - self.centroids[c]
                far = np.einsum("ij,ij->i", gap, gap) if gap.dtype != object else (gap * gap).sum(axis=1)
                nearer = (best[rows] < 0) | (far < distance[rows]) | ((far == distance[rows]) & (c < best[rows]))
                best[rows[nearer]], distance[rows[nearer]] = c, far[nearer]
        return best, distance


def _chunks(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple]:
    """(column of ids, vectors, numbers, distances) of every part of a batch."""
    width = centroids.shape[1]
    exact = Lists(centroids)
    fast = Lists(centroids.astype(np.float64)) if width <= 2048 and abs(centroids).max() < _FAST else None
    for batch in batches:
        for at in range(0, batch.num_rows, _CHUNK):
            part = batch.slice(at, _CHUNK)
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            vectors = whole_components(flat.reshape(-1, width))
            if fast and vectors.dtype != object:
                yield part.column(0), vectors, *fast.nearest(vectors)
            else:
                vectors = _whole(vectors)
                yield part.column(0), vectors, *exact.nearest(vectors)


_PER_CLUSTER = "cluster_inertia long, inertia long, centroid_sha256 string"
_SUMS = "cluster int, n long, sums array<decimal(38,0)>"


def _sums(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [0] * len(centroids)
        sums = np.zeros(centroids.shape, object)
        for _, vectors, number, _ in _chunks(batches, centroids):
            for c in np.unique(number).tolist():
                rows = vectors[number == c]
                counts[c] += len(rows)
                sums[c] += _whole(rows.sum(axis=0))
        found = [c for c, n in enumerate(counts) if n]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), pa.array([counts[c] for c in found], pa.int64()),
             pa.array([[Decimal(int(v)) for v in sums[c]] for c in found], pa.list_(pa.decimal128(38, 0)))],
            names=["cluster", "n", "sums"],
        )

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, number, distance in _chunks(batches, centroids):
            far = [min(int(d), _MOST) for d in distance.tolist()]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(number, pa.int32()), pa.array(far, pa.int64())], names=["vec_id", "cluster", "distance"]
            )

    return run


def kept_vectors(embeddings: DataFrame, width: int = WIDTH) -> DataFrame:
    """vec_id and embedding of the vectors with `width` components, none null, NaN or infinite."""
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    good = (F.size("embedding") == width) & finite
    return embeddings.where(F.coalesce(good, F.lit(False))).select("vec_id", "embedding")


def _starts(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """Components of the k vectors whose ids have the least digests; ties by their components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = kept.select("embedding", digest.alias("d")).orderBy(F.col("d").asc_nulls_last(), "embedding").limit(k)
    rows = [r.embedding for r in first.collect()]
    return _whole(whole_components(np.array(rows, np.float64)))


def clusters(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors with another number of components, a null one, or a component that is null or not
    finite are left out. Components are floor(256 x). The k vectors with the least sha256 of
    `seed:vec_id` are the first centroids, in that order (a null vec_id last, ties by components);
    with fewer vectors there are fewer centroids. A round gives each vector to its nearest centroid,
    the smaller number on ties, and moves each centroid that has vectors to the floor of their mean.
    Repeated rows count as often as they stand. Sums are exact; a squared distance or inertia
    beyond a long is given as the greatest long, a component beyond 2**96 counts as that. An empty table gives an empty result. Columns
    but vec_id and embedding are not read.
    """
    kept = kept_vectors(embeddings, width)
    centroids = _starts(kept, k, seed)
    schema = "vec_id long, cluster int, distance long"
    if not len(centroids):
        return kept.sparkSession.createDataFrame([], f"{schema}, {_PER_CLUSTER}")
    for _ in range(rounds):
        parts = kept.mapInArrow(_sums(centroids), _SUMS)
        total = parts.select("cluster", "n", F.posexplode("sums").alias("d", "x")).groupBy("cluster", "d").agg(
            F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")
        )
        moved = centroids.copy()
        for r in total.collect():  # at most k * width numbers
            moved[r.cluster, r.d] = int(r.x) // r.n
        centroids = moved
    rows = stored(kept.mapInArrow(_assigned(centroids), schema), "assigned")
    inertia = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))
    found = inertia.collect()  # at most k rows
    everything = min(sum(int(r["sum"]) for r in found), _MOST)
    digests = [hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest() for c in centroids]
    told = [(r.cluster, min(int(r["sum"]), _MOST), everything, digests[r.cluster]) for r in found]
    per_cluster = rows.sparkSession.createDataFrame(told, f"cluster int, {_PER_CLUSTER}")
    return rows.join(F.broadcast(per_cluster), "cluster").select(  # at most k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
