"""Centroid clustering of integer vectors with Ptolemaic pivot bounds.

For points q, o and pivots p, s, Ptolemy's inequality holds in Euclidean space::

    d(q, o) * d(p, s) >= | d(q, p) * d(o, s) - d(q, s) * d(o, p) |

Each vector's distances to a few fixed pivots are measured once and staged with
it. In a round only the centroids' distances to the pivots are new, and every
pair of pivots gives a lower bound of the distance from each vector to each
centroid. Bounds are rounded down, so a centroid is passed over only if it is
farther than one whose distance is known. The others are checked exactly, in
64-bit integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.shared import one_thread, stage, write_stage

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
PIVOTS = 4
#: Largest integer component: beyond it a squared distance does not fit 64 bits.
LARGEST = 1 << 27
_EPS = float(np.finfo(np.float64).eps)
_CACHED = "vec_id long, y binary, to_pivots binary"


def integer_vectors(column: pa.Array, dimensions: int = DIMENSIONS, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and floor(scale * x) of the vectors that are kept (length, no null, finite, in bounds)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = np.flatnonzero(pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False) == dimensions)
    flat = pc.fill_null(column.take(pa.array(rows)).flatten(), float("nan"))
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dimensions)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(scale * values)
        ok = (np.abs(scaled) <= LARGEST).all(1)   # false for NaN and infinities
    return rows[ok], scaled[ok].astype(np.int64)


def squared(y: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one point."""
    diff = y - point
    return np.einsum("ij,ij->i", diff, diff)


def choose_pivots(points: np.ndarray, most: int = PIVOTS) -> np.ndarray:
    """Farthest-first choice of distinct points, so that pairs of pivots lie far apart."""
    if not len(points):
        return points
    chosen, near = [0], squared(points, points[0])
    while len(chosen) < most and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, squared(points, points[chosen[-1]]))
    return points[chosen]


def distances_to(y: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of rows to points, rounded to the nearest double."""
    return np.sqrt(np.stack([squared(y, p) for p in points], 1).astype(np.float64)) if len(points) else np.zeros((len(y), 0))


def lower_bounds(to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """For each row and centroid a number that is at most their distance."""
    own, between = distances_to(centroids, pivots), distances_to(pivots, pivots)
    low = np.zeros((len(to_pivots), len(centroids)))
    for p, s in combinations(range(len(pivots)), 2):
        a = to_pivots[:, p, None] * own[None, :, s]
        b = to_pivots[:, s, None] * own[None, :, p]
        # roots and products are off by at most 3 half units each; the slack covers them and the division
        np.maximum(low, (np.abs(a - b) - 8 * _EPS * (a + b)) / between[p, s] * (1 - 8 * _EPS), out=low)
    return low


def nearest(y: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid (ties: the smaller), squared distance, and how many distances were worked out."""
    low = lower_bounds(to_pivots, centroids, pivots)
    guess = low.argmin(1)
    cluster = guess.copy()
    diff = y - centroids[guess]
    best = np.einsum("ij,ij->i", diff, diff)
    low = low * low * (1 - 4 * _EPS)
    checked = len(y)
    for k in range(len(centroids)):
        rows = np.flatnonzero((low[:, k] <= best.astype(np.float64) * (1 + 4 * _EPS)) & (guess != k))
        checked += len(rows)
        if len(rows):
            d = squared(y[rows], centroids[k])
            take = (d < best[rows]) | ((d == best[rows]) & (k < cluster[rows]))
            best[rows[take]], cluster[rows[take]] = d[take], k
    return cluster, best, checked


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows, y = integer_vectors(b.column("vector"))
        yield pa.RecordBatch.from_arrays([b.column("vec_id").take(pa.array(rows)), pa.array(y.tolist(), pa.list_(pa.int32()))], ["vec_id", "y"])


def _cache(batches: Iterator[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows, y = integer_vectors(b.column("vector"))
        yield pa.RecordBatch.from_arrays([
            b.column("vec_id").take(pa.array(rows)), pa.array([v.tobytes() for v in y.astype("<i4")], pa.binary()),
            pa.array([d.tobytes() for d in distances_to(y, pivots).astype("<f8")], pa.binary())], ["vec_id", "y", "to_pivots"])


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, pivots: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    one_thread()
    for b in batches:
        y = _matrix(b.column("y"), "<i4", DIMENSIONS).astype(np.int64)
        cluster, distance, _ = nearest(y, _matrix(b.column("to_pivots"), "<f8", len(pivots)), centroids, pivots)
        yield b, y, cluster, distance


def _sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Component sums and row counts by cluster of one task."""
    total, n = np.zeros((len(centroids), DIMENSIONS), np.int64), np.zeros(len(centroids), np.int64)
    for _, y, cluster, _ in _assigned(batches, centroids, pivots):
        for k in np.unique(cluster):
            total[k] += y[cluster == k].sum(0)
        n += np.bincount(cluster, minlength=len(centroids))
    k, i = np.nonzero(np.repeat(n[:, None], DIMENSIONS, 1))
    yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(i, pa.int32()), pa.array(total[k, i], pa.int64()), pa.array(n[k], pa.int64())],
                                     ["cluster", "i", "total", "n"])


def _place(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b, _, cluster, distance in _assigned(batches, centroids, pivots):
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(c)) for c in centroid).encode()).hexdigest()


def cluster_vectors(vectors: DataFrame, vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each kept row of ``vectors`` (vec_id, vector).

    Kept are vectors of 64 components, none null or non-finite, which become
    integers floor(64 * x). The ``clusters`` vectors with the smallest sha256 of
    ``1:<vec_id>`` are the first centroids. The driver collects these, and after
    each round one sum for each cluster and dimension, whatever the number of
    rows; tasks add up their rows before the shuffle, so a cluster that holds
    most rows is no larger than another.

    Edge cases: a null vec_id hashes as empty text; rows that share a vec_id are
    all kept, and as first centroids they follow their components; with fewer
    vectors than ``clusters`` there are fewer centroids, and equal centroids
    leave the later one empty, which stays; an empty table gives an empty
    result; other columns are not read. A component beyond 2**27 after scaling
    has no 64-bit distance, its vector is not kept.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    seeds = rows.mapInArrow(_kept, "vec_id long, y array<int>").select(digest.alias("digest"), "y").orderBy("digest", "y").limit(clusters).collect()
    centroids = np.array([r["y"] for r in seeds], np.int64).reshape(len(seeds), DIMENSIONS)
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia decimal(38,0), inertia decimal(38,0), centroid_sha256 string")
    pivots = choose_pivots(centroids)
    cached = write_stage(rows.mapInArrow(lambda b: _cache(b, pivots), _CACHED), "pivot-distances")
    for _ in range(rounds):
        now = centroids.copy()
        sums = (cached.mapInArrow(lambda b, now=now: _sums(b, now, pivots), "cluster int, i int, total long, n long")
                .groupBy("cluster", "i").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")))
        for r in sums.collect():
            centroids[r["cluster"], r["i"]] = int(r["total"]) // r["n"]
    placed = stage(cached.mapInArrow(lambda b: _place(b, centroids, pivots), "vec_id long, cluster int, distance long"))
    inertia = {r["cluster"]: int(r["d"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    # one row for each cluster
    about = rows.sparkSession.createDataFrame([(k, str(d), str(sum(inertia.values())), centroid_digest(centroids[k])) for k, d in inertia.items()],
                                              "cluster int, cluster_inertia string, inertia string, centroid_sha256 string")
    about = about.withColumn("cluster_inertia", F.col("cluster_inertia").cast("decimal(38,0)")).withColumn("inertia", F.col("inertia").cast("decimal(38,0)"))
    return placed.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
