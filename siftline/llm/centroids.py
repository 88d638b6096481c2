"""Centroid clustering in whole numbers, with Hamerly's bounds.

Vectors become integers, so sums, means and squared distances are exact and every run gives the same clusters. A vector
keeps one upper bound on the distance to its centroid and one lower bound on the distance to any other. When centroids
move, the upper bound grows by its own centroid's drift and the lower one shrinks by the largest drift of the others; a
vector stays where its upper bound is below the lower one, or below half the way from its centroid to the next one.
Otherwise the upper bound is made exact, and what is still ambiguous gets a full scan of exact squared distances, with
ties to the smaller number. Square roots are rounded away from the claim they support, so no bound is ever too tight.

Vectors, clusters and bounds are a table that is written each round; lost executors repeat a part of one round. No
round shuffles vectors: each task sums what it has by cluster, and k rows a task meet.

Defined results: only vectors of `dims` components, none null or non-finite, take part; so do those whose integers are
LIMIT at most, since squared distances have to fit 64 bits. Rows of equal ids are vectors of their own; ones with a null
id are clustered like others and start a centroid only where ids run out. Equal hashes are ordered by their vectors.
With fewer vectors than k there are as many centroids; an empty table gives an empty result. Sums are 64-bit integers
(2**36 vectors at the limit); an inertia beyond them is null. Only the named columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import discard, map_batches, materialize

#: Largest integer component: 64 squares of twice as much fit 64 bits.
LIMIT = 1 << 27
#: Full scans hold so many distances at once.
SCANNED = 1 << 20
_SLACK = 2.0**-50
STATE = "vec_id {kind}, v binary, cluster int, upper double, lower double"


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows x to integer rows c."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    kind = np.float64 if 4 * most * most * x.shape[1] < 1 << 53 else np.int64  # sums of floats are exact up to 2**53
    x, c = x.astype(kind), c.astype(kind)
    return (np.einsum("ij,ij->i", x, x)[:, None] - 2 * (x @ c.T) + np.einsum("ij,ij->i", c, c)).astype(np.int64)


def at_most(square: np.ndarray) -> np.ndarray:
    """A number not below the square root."""
    return np.sqrt(square.astype(np.float64)) * (1 + _SLACK)


def at_least(square: np.ndarray) -> np.ndarray:
    """A number not above the square root."""
    return np.sqrt(square.astype(np.float64)) * (1 - _SLACK)


def scan(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the smaller number), upper and lower bound."""
    near, upper, lower = np.zeros(len(x), np.int32), np.zeros(len(x)), np.full(len(x), np.inf)
    step = max(1, SCANNED // len(c))
    for at in range(0, len(x), step):
        part = slice(at, at + step)
        d = squared(x[part], c)
        near[part] = d.argmin(1)
        rows = np.arange(len(d))
        upper[part] = at_most(d[rows, near[part]])
        if len(c) > 1:
            d[rows, near[part]] = np.iinfo(np.int64).max
            lower[part] = at_least(d.min(1))
    return near, upper, lower


def moved(old: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each centroid: how far it moved at most, how far any other did, and half the way to the nearest other one."""
    drift = at_most(((new - old) ** 2).sum(1))
    others = np.array([np.delete(drift, j).max(initial=0.0) for j in range(len(new))])
    apart = squared(new, new)
    np.fill_diagonal(apart, np.iinfo(np.int64).max)
    half = at_least(apart.min(1)) / 2 if len(new) > 1 else np.full(1, np.inf)
    return drift, others, half


def reassign(x: np.ndarray, new: np.ndarray, moves: tuple, near: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Clusters and bounds after centroids moved to `new`, and how many vectors were scanned."""
    drift, others, half = moves
    near, upper = near.copy(), (upper + drift[near]) * (1 + _SLACK)
    lower = lower - others[near] - np.where(np.isfinite(lower), _SLACK * (lower + others[near]), 0.0)
    open_ = np.flatnonzero(upper >= np.maximum(lower, half[near]))
    if len(open_):
        own = np.zeros(len(open_), np.int64)
        for j in np.unique(near[open_]):
            mine = near[open_] == j
            own[mine] = squared(x[open_[mine]], new[j : j + 1])[:, 0]
        upper[open_] = at_most(own)
        open_ = open_[upper[open_] >= np.maximum(lower[open_], half[near[open_]])]
        near[open_], upper[open_], lower[open_] = scan(x[open_], new)
    return near, upper, lower, len(open_)


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(-1, dims).astype(np.int64)


def _state(ids: pa.Array, v: pa.Array, near: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids, v, pa.array(near, pa.int32()), pa.array(upper), pa.array(lower)], ["vec_id", "v", "cluster", "upper", "lower"])


def _first(vectors: DataFrame, centroids: np.ndarray, kind: str) -> DataFrame:
    sent = vectors.sparkSession.sparkContext.broadcast(centroids)  # k vectors

    def make():
        c = sent.value

        def each(b):
            return _state(b.column(0), b.column(1), *scan(_vectors(b.column(1), c.shape[1]), c))

        return each

    return map_batches(vectors, make, STATE.format(kind=kind))


def _again(state: DataFrame, old: np.ndarray, new: np.ndarray, kind: str) -> DataFrame:
    sent = state.sparkSession.sparkContext.broadcast((new, moved(old, new)))  # k vectors

    def make():
        c, moves = sent.value

        def each(b):
            near, upper, lower = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
            return _state(b.column(0), b.column(1), *reassign(_vectors(b.column(1), c.shape[1]), c, moves, near, upper, lower)[:3])

        return each

    return map_batches(state, make, STATE.format(kind=kind))


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floor of each cluster's mean; an empty cluster keeps its centroid. k rows from a task, k * dims to the driver."""
    k, dims = centroids.shape

    def sums(batches):
        total, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for b in batches:
            x, near = _vectors(b.column(0), dims), b.column(1).to_numpy(zero_copy_only=False)
            for j in np.unique(near):
                mine = x[near == j]
                total[j] += mine.sum(0)
                n[j] += len(mine)
        has = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(has, pa.int32()), pa.array(n[has]), pa.array(total[has].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "total"])

    parts = state.select("v", "cluster").mapInArrow(sums, "cluster int, n long, total array<long>")
    each = parts.select("cluster", "n", F.posexplode("total").alias("at", "total"))
    new = centroids.copy()
    for r in each.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        new[r["cluster"], r["at"]] = r["total"] // r["n"]
    return new


def integers(df: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v: vectors that take part, floor(scale * x) of each component as 32-bit integers."""
    x = F.col("v")
    fits = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) * scale < float(LIMIT))
    rows = df.select(df[id_col].alias("vec_id"), df[vector_col].cast("array<double>").alias("v"))
    rows = rows.where(x.isNotNull() & (F.size(x) == dims)).where(F.forall(x, fits))

    def make():
        def each(b):
            v = b.column(1)
            whole = np.floor(scale * v.flatten().to_numpy(zero_copy_only=False)).astype(np.int32).reshape(-1, dims)
            return pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in whole], pa.binary())], ["vec_id", "v"])

        return each

    return map_batches(rows, make, f"vec_id {dict(rows.dtypes)['vec_id']}, v binary")


def starts(vectors: DataFrame, k: int, dims: int, seed: int) -> np.ndarray:
    """The k vectors whose ids, behind the seed, have the smallest hashes."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = vectors.orderBy(place.asc_nulls_last(), F.col("v")).limit(k).select("v").collect()  # k rows
    return np.array([np.frombuffer(r["v"], np.int32) for r in first], np.int64).reshape(-1, dims)


def cluster(df: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256, after `rounds` rounds of
    assigning all vectors and moving centroids, and one more assignment."""
    spark = df.sparkSession
    vectors = materialize(integers(df, dims, scale, id_col, vector_col), "integers")
    kind = dict(vectors.dtypes)["vec_id"]
    centroids = starts(vectors, k, dims, seed)
    if not len(centroids):
        return vectors.selectExpr("vec_id", "0 cluster", "0L distance", "0L cluster_inertia", "0L inertia", "'' centroid_sha256")
    state = materialize(_first(vectors, centroids, kind), "clusters")
    discard(vectors)
    for _ in range(rounds):
        new = _means(state, centroids)
        after = materialize(_again(state, centroids, new, kind), "clusters")
        discard(state)
        state, centroids = after, new
    sent = spark.sparkContext.broadcast(centroids)

    def make():
        c = sent.value

        def each(b):
            x, near = _vectors(b.column(1), dims), b.column(2).to_numpy(zero_copy_only=False)
            own = ((x - c[near]) ** 2).sum(1)
            return pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(own)], ["vec_id", "cluster", "distance"])

        return each

    found = materialize(map_batches(state.select("vec_id", "v", "cluster"), make, f"vec_id {kind}, cluster int, distance long"), "distances")
    discard(state)
    by = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    long = lambda n: n if n < 1 << 63 else None
    rows = [(j, long(n), long(sum(by.values())), hashlib.sha256(",".join(map(str, centroids[j].tolist())).encode()).hexdigest()) for j, n in sorted(by.items())]
    info = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(info), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
