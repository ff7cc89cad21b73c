"""Centroid clustering of integer vectors with Hamerly's bounds.

Each component x becomes floor(scale * x).  Every vector carries an upper bound of the distance to its own centroid and one lower bound
of that to its second nearest.  When centroids move, the upper bound grows by the own centroid's drift and the lower one shrinks by the largest
drift of the others; while upper < max(lower, half the way from the own centroid to its nearest neighbour) the vector stays without
looking at any centroid.  Otherwise the upper bound is made exact, and if that doesn't settle it, all centroids are scanned.
Scans are in exact integers; bounds are rounded outwards, so they never settle a tie.  So assignments are those of plain rounds:
nearest centroid, of equals the smaller number; then each centroid that has vectors becomes their componentwise floor(sum / count).

Bounds and clusters are written to the shared folder with each round, beside the vectors, so a round is one pass without a shuffle;
what is shuffled and what the driver sees are the sums, a row for each centroid and component.

Kept are vectors with exactly ``dim`` components, none null or not finite, whose integers lie within +-2 ** 27: beyond that squared distances
don't fit the result's long.  Starting centroids are the kept vectors with the smallest sha256 of ``seed:id``, of equals by id, then by
vector; rows without an id come last in that order.  Repeated rows are vectors of their own.  With fewer vectors than ``k`` there are as many centroids
as vectors, and an empty table has an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import materialize, output, scratch

K, ROUNDS, DIM, SCALE, SEED = 16, 3, 64, 64, "1"
#: The largest integer component.
LARGEST = 1 << 27
_UP, _DOWN = 1 + 2.0**-50, 1 - 2.0**-50
_STATE = "id long, v array<int>, cluster int, upper double, lower double, settled int"


def integers(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """id and v (integers) of the kept vectors."""
    x = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * scale))
    sound = (F.size(vector) == dim) & F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double") * scale) <= LARGEST, F.lit(False)) & ~F.isnan(c.cast("double")))
    return vectors.where(sound).select(F.col(key).cast("long").alias("id"), F.transform(x, lambda c: c.cast("int")).alias("v"))


def starts(vectors: DataFrame, k: int = K, seed: str = SEED) -> np.ndarray:
    """(up to ``k``, dim) centroids; the driver sees these rows only."""
    by = F.sha2(F.encode(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), "UTF-8"), 256)
    first = vectors.select("id", "v", by.alias("h")).orderBy(F.col("h").asc_nulls_last(), F.col("id").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r.v for r in first], np.int64)


def squared(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(vectors, centroids) exact squared distances."""
    return np.stack([((v - c) ** 2).sum(1) for c in centroids], 1)


def _scan(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid, its distance rounded up and the second nearest's rounded down."""
    d = squared(v, centroids)
    own = d.argmin(1)
    near = d[np.arange(own.size), own]
    if centroids.shape[0] == 1:
        return own, np.sqrt(near) * _UP, np.full(own.size, np.inf)
    return own, np.sqrt(near) * _UP, np.sqrt(np.partition(d, 1, 1)[:, 1]) * _DOWN


def moved(old: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each centroid: its drift, and the largest drift of the others, rounded up."""
    drift = np.sqrt(((new - old) ** 2).sum(1)) * _UP
    others = np.array([np.delete(drift, j).max(initial=0.0) for j in range(drift.size)])
    return drift, others


def half_ways(centroids: np.ndarray) -> np.ndarray:
    """Of each centroid half the distance to the nearest other one, rounded down."""
    d = squared(centroids, centroids).astype(np.float64)
    np.fill_diagonal(d, np.inf)
    return np.sqrt(d.min(1)) * _DOWN / 2


def tightened(v: np.ndarray, own: np.ndarray, upper: np.ndarray, lower: np.ndarray, old: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Clusters and bounds after the centroids moved, and which vectors were settled without looking at other centroids than their own."""
    drift, others = moved(old, new)
    upper = (upper + drift[own]) * _UP
    lower = np.maximum(lower - others[own], 0) * _DOWN
    bound = np.maximum(lower, half_ways(new)[own])
    open_ = np.flatnonzero(upper >= bound)
    upper[open_] = np.sqrt(((v[open_] - new[own[open_]]) ** 2).sum(1)) * _UP
    settled = upper < bound
    open_ = np.flatnonzero(~settled)
    own = own.copy()
    own[open_], upper[open_], lower[open_] = _scan(v[open_], new)
    return own, upper, lower, settled


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def assigned(state: DataFrame, new: np.ndarray, old: np.ndarray | None = None) -> DataFrame:
    """The state after one assignment; without ``old``, of vectors that have no bounds yet."""
    schema = pa.schema([("id", pa.int64()), ("v", pa.list_(pa.int32())), ("cluster", pa.int32()), ("upper", pa.float64()), ("lower", pa.float64()), ("settled", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column("v"))
            if old is None:
                (own, upper, lower), settled = _scan(v, new), np.zeros(batch.num_rows, np.int32)
            else:
                held = (batch.column(c).to_numpy() for c in ("cluster", "upper", "lower"))
                own, upper, lower, skipped = tightened(v, *(x.copy() for x in held), old, new)
                settled = batch.column("settled").to_numpy() + skipped
            yield output(schema, id=batch.column("id"), v=batch.column("v").cast(pa.list_(pa.int32())), cluster=own.astype(np.int32), upper=upper, lower=lower, settled=settled.astype(np.int32))

    return state.mapInArrow(run, _STATE)


def means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after an assignment: floors of exact means; one without vectors stays."""
    schema = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            own = batch.column("cluster").to_numpy()
            v = _matrix(batch.column("v")) if batch.num_rows else np.zeros((0, dim), np.int64)
            for j in np.unique(own):
                sums[j] += v[own == j].sum(0)
            n += np.bincount(own, minlength=k)
        some = np.flatnonzero(n)
        yield output(schema, cluster=some.astype(np.int32), n=n[some], sums=pa.array(list(sums[some]), pa.list_(pa.int64())))

    parts = state.select("cluster", "v").mapInArrow(run, "cluster int, n long, sums array<long>")
    wide = parts.select("cluster", "n", F.posexplode("sums").alias("place", "part"))
    new = centroids.copy()
    for r in wide.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect():  # k x dim rows
        new[r["cluster"], r["place"]] = int(r["total"]) // int(r["n"])
    return new


def cluster(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", dim: int = DIM, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, seed: str = SEED) -> tuple[DataFrame, np.ndarray]:
    """``key``, cluster, distance (squared) and settled (in how many of the later assignments the bounds decided without a scan) of every kept vector, written, and the centroids."""
    ints, drop = scratch(integers(vectors, vector, key, dim, scale), "integers")
    centroids = starts(ints, k, seed)
    if not centroids.size:
        return ints.select(F.col("id").alias(key), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0).alias("settled")), np.zeros((0, dim), np.int64)
    state, old = ints, None
    for _ in range(rounds):
        state, drop_next = scratch(assigned(state, centroids, old), "bounds")
        drop()
        drop = drop_next
        old, centroids = centroids, means(state, centroids)
    last = assigned(state, centroids, old)
    schema = pa.schema([(key, pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64()), ("settled", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("cluster").to_numpy()
            distance = ((_matrix(batch.column("v")) - centroids[own]) ** 2).sum(1) if own.size else np.zeros(0, np.int64)
            yield output(schema, **{key: batch.column("id")}, cluster=own, distance=distance, settled=batch.column("settled"))

    found = materialize(last.mapInArrow(run, f"{key} long, cluster int, distance long, settled int"), "clusters")
    drop()
    return found, centroids


def summed(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``found`` with cluster_inertia, inertia and centroid_sha256."""
    spark = found.sparkSession
    exact = F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")
    held = {r["cluster"]: int(r["inertia"]) for r in found.groupBy("cluster").agg(exact).collect()}  # a row for each centroid
    whole = sum(held.values())
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(j, held[j], whole, sha[j]) for j in held]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster")  # a row for each centroid
