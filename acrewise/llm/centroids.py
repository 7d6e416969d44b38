"""Centroid clustering of integer vectors with Ptolemaic pivots.

Vectors are floored multiples of their components, so distances, sums and centroids are exact whole numbers. Lloyd rounds
assign every vector to its nearest centroid (ties: the smaller number) and move each centroid to the floored mean.

* Pivots are a few of the first centroids, far from each other, and stay fixed. Each vector's distances to them are computed once
  and stored beside it. For a pair of pivots p, q Ptolemy's inequality gives

      d(x, c) d(p, q) >= | d(x, p) d(c, q) - d(x, q) d(c, p) |

  so a round knows a lower bound for every centroid from cached numbers alone; the best pair counts.
* The vector's exact distance to the centroid of the least bound is its upper bound. A centroid whose lower bound, less a margin
  for the roundings of double arithmetic, exceeds it is skipped; all others are checked with whole numbers.
* A task adds up its vectors by cluster before anything is shuffled: a row per cluster and task, k * dims sums to the driver.

Kept are vectors with exactly ``dims`` components, none null, NaN or infinite. A component beyond ``LARGEST`` after scaling fails
the job with a message, since its squared distances do not fit a long. Repeated rows are vectors of their own; a null
id is hashed as no digits. Fewer kept vectors than ``k`` give fewer centroids; no kept vector, or an empty table, gives an empty
table. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acrewise.scale import stage

PIVOTS = 6
LARGEST = 1 << 27
#: bound of the relative error of a few chained double operations, many times over
_MARGIN = 1e-13
_CELLS = 1 << 20

ASSIGNED = "vec_id long, cluster int, distance long"


def vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64, scale: int = 64) -> DataFrame:
    """vec_id and the whole-number vector ``v`` of the kept rows."""
    parts = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    far = F.exists("v", lambda x: F.abs(x * scale) >= LARGEST)
    floored = F.transform("v", lambda x: F.floor(x * scale).cast("int"))
    message = F.concat(F.lit("a component is too large for whole distances: vec_id "), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), parts.alias("v"))
    kept = rows.where((F.size("v") == dims) & ~F.coalesce(bad, F.lit(False)))
    return kept.select("vec_id", F.when(far, F.raise_error(message)).otherwise(floored).alias("v"))


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to ``c``."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def pivots_of(centroids: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Up to ``count`` different centroids, each the farthest from those before it."""
    chosen = centroids[:1]
    while len(chosen) < min(count, len(centroids)):
        nearest = np.min([_squared(centroids, p) for p in chosen], 0)
        if not nearest.max():
            break
        chosen = np.concatenate([chosen, centroids[[int(nearest.argmax())]]])
    return chosen


def bounds(cached: np.ndarray, of_centroids: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Lower bounds (rows x centroids) from the distances of rows, of centroids, and of pivots to the pivots; never too high."""
    best = np.zeros((len(cached), len(of_centroids)))
    for p, q in combinations(range(len(between)), 2):
        one = cached[:, [p]] * of_centroids[:, q]
        other = cached[:, [q]] * of_centroids[:, p]
        gap = np.abs(one - other) - _MARGIN * (one + other)
        np.maximum(best, gap * ((1 - _MARGIN) / between[p, q]), out=best)
    return best


def nearest(x: np.ndarray, cached: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid and squared distance of each row, and how many distances were computed."""
    of_centroids = np.sqrt(np.stack([_squared(centroids, p) for p in pivots], 1).astype(float))
    between = np.sqrt(np.stack([_squared(pivots, p) for p in pivots], 1).astype(float))
    least = bounds(cached, of_centroids, between)
    cluster = least.argmin(1)
    distance = _squared(x, centroids[cluster])
    checked = len(x)
    reach = least * least * (1 - _MARGIN)
    first = cluster.copy()
    for c in range(len(centroids)):
        at = np.flatnonzero((first != c) & (reach[:, c] <= distance))
        if not len(at):
            continue
        checked += len(at)
        found = _squared(x[at], centroids[c])
        better = (found < distance[at]) | ((found == distance[at]) & (c < cluster[at]))
        cluster[at[better]], distance[at[better]] = c, found[better]
    return cluster, distance, checked


def _matrix(column, dims: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, dims)


def _with_distances(kept: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``kept`` with the cached distances ``pd`` to the pivots."""
    dims = pivots.shape[1]

    def run(batches):
        for b in batches:
            x = _matrix(b.column(1), dims, np.int64)
            far = np.sqrt(np.stack([_squared(x, p) for p in pivots], 1).astype(float))
            ends = pa.array(np.arange(0, far.size + 1, far.shape[1], dtype=np.int32))
            cached = pa.ListArray.from_arrays(ends, pa.array(far.reshape(-1)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), cached], ["vec_id", "v", "pd"])

    return kept.mapInArrow(run, "vec_id long, v array<int>, pd array<double>")


def _assigned_batches(batches, centroids: np.ndarray, pivots: np.ndarray):
    dims = centroids.shape[1]
    step = max(1, _CELLS // dims)
    for whole in batches:
        for at in range(0, whole.num_rows, step):
            b = whole.slice(at, step)
            x = _matrix(b.column(1), dims, np.int64)
            cluster, distance, _ = nearest(x, _matrix(b.column(2), len(pivots), float), centroids, pivots)
            yield b.column(0), x, cluster, distance


def assign(cached: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    def run(batches):
        for ids, _, cluster, distance in _assigned_batches(batches, centroids, pivots):
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return cached.mapInArrow(run, ASSIGNED)


def moved(cached: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after a round; one without vectors stays."""
    shape = centroids.shape

    def run(batches):
        sums, counts = np.zeros(shape, np.int64), np.zeros(shape[0], np.int64)
        for _, x, cluster, _ in _assigned_batches(batches, centroids, pivots):
            for c in np.unique(cluster):
                own = cluster == c
                sums[c] += x[own].sum(0)
                counts[c] += own.sum()
        at = np.flatnonzero(counts)
        total = pa.array([row.tolist() for row in sums[at]], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at]), total], ["cluster", "n", "total"])

    parts = cached.mapInArrow(run, "cluster int, n long, total array<long>").select("cluster", "n", F.posexplode("total").alias("at", "part"))
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    out = centroids.copy()
    for r in parts.groupBy("cluster", "at").agg(exact("n").alias("n"), exact("part").alias("part")).collect():
        out[r["cluster"], r["at"]] = int(r["part"]) // int(r["n"])
    return out


def first_centroids(kept: DataFrame, k: int, dims: int, seed: str) -> np.ndarray:
    mark = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.select(mark.alias("mark"), "v").orderBy("mark", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64).reshape(-1, dims)


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def _of_cluster(values: list, kind: str) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)


def clusters(
    table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: str = "1:"
) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    kept = vectors(table, id_col, vec_col, dims, scale)
    centroids = first_centroids(kept, k, dims, seed)
    if not len(centroids):
        kinds = {"cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long", "centroid_sha256": "string"}
        return kept.where(F.lit(False)).select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in kinds.items()])
    pivots = pivots_of(centroids)
    cached = stage(_with_distances(kept, pivots), "vectors")
    for _ in range(rounds):
        centroids = moved(cached, centroids, pivots)
    found = stage(assign(cached, centroids, pivots), "assigned")
    own = dict(found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    inertias = [int(own.get(c, 0)) for c in range(len(centroids))]
    facts = [
        _of_cluster(inertias, "long").alias("cluster_inertia"),
        F.lit(sum(inertias)).cast("long").alias("inertia"),
        _of_cluster([digest(c) for c in centroids], "string").alias("centroid_sha256"),
    ]
    return found.select("vec_id", "cluster", "distance", *facts)
