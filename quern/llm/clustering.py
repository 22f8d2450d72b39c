"""Clustering of integer vectors round centroids, with geometric drift tightening.

Every vector carries an upper bound of the distance to its own centroid and a lower
bound of the distance to all others.  When centroids move, the upper bound grows by the
own centroid's drift.  The lower bound would have to shrink by the largest drift of any
other centroid; planar geometry gives less.  All vectors of a cluster lie in a sphere
round its old centroid.  For another centroid that moves from a to b, the points that
come nearer by f lie inside a hyperbola with foci a and b in the plane of a, b and the
point; its asymptotes leave the midpoint of a and b at the angle arccos(f / |ab|).  So
no point of the sphere comes nearer by more than |ab| times the cosine of the smallest
angle between the direction of the move and the sphere, as seen from the midpoint, and
none at all when the sphere lies behind the midpoint.  A vector whose bounds still
separate keeps its cluster unread; the others are compared exactly, first with their
own centroid and, if that does not settle it, with all.

Each round writes one table to the shared folder: vectors with their cluster and
bounds, and one tally per task (sums, counts, radii) that the next centroids are made
of.  A task that runs again replaces its rows and its tally together, so a lost
executor costs one round at most and counts nothing twice.  The driver holds the
centroids only: ``clusters`` times ``components`` numbers.

Defined results: a vector with another number of components, or a NULL or non-finite
component, is left out; a NULL vec_id is an ordinary vector that starts a cluster last;
rows that repeat a vec_id are vectors of their own; ties go to the smaller cluster;
with fewer vectors than clusters every vector starts one; an empty table gives an empty
result; components whose squared distances could pass 64 bits (2 ** 27 after scaling,
for 64 of them) raise an error; columns besides the two that are named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import materialize

#: Relative slack of bounds, far above the rounding of doubles.
SLACK = 1e-9
_STATE = "vec_id long, vector binary, cluster int, upper double, lower double, tally binary"
_TOTALS = "cluster int, place int, total long, radius double, compared long"


def scaled(batch: pa.RecordBatch, components: int, scale: float) -> tuple[pa.Array, np.ndarray]:
    """Ids and floor(scale * x) of the whole vectors of a batch."""
    ids, lists = batch.column(0), batch.column(1)
    whole = pc.equal(pc.fill_null(pc.list_value_length(lists), -1), components)
    ids, lists = ids.filter(whole), lists.filter(whole)
    values = lists.flatten().cast(pa.float64())
    known = np.asarray(values.is_valid()).reshape(-1, components).all(axis=1)
    x = values.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, components)
    known &= np.isfinite(x).all(axis=1)
    x = np.floor(scale * x[known])
    _refuse_large(np.abs(x).max(initial=0), components)
    return ids.filter(pa.array(known)), x.astype(np.int64)


def _refuse_large(most: float, components: int) -> None:
    if components * (2 * float(most)) ** 2 >= 2.0**63:
        raise ValueError("components are too large for exact 64-bit distances")


def packed(x: np.ndarray) -> pa.Array:
    """Rows as binary values of the narrowest integer kind that holds the batch."""
    most = int(np.abs(x).max(initial=0))
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max)
    data = np.ascontiguousarray(x.astype(kind))
    bounds = np.arange(len(x) + 1, dtype=np.int32) * (data.itemsize * x.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def unpacked(column: pa.Array, components: int) -> np.ndarray:
    width = pc.binary_length(column).to_numpy() // components
    out = np.empty((len(column), components), dtype=np.int64)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        part = b"".join(column.take(pa.array(rows)).to_pylist())
        out[rows] = np.frombuffer(part, dtype=f"<i{w}").reshape(-1, components)
    return out


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to all centroids."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if x.shape[1] * (2 * most) ** 2 < 2**53:  # every term is exact in doubles
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        out = (a * a).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * (a @ c.T)
        return out.astype(np.int64)
    return np.stack([own_distances(x, np.broadcast_to(c, x.shape)) for c in centroids], axis=1)


def own_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to the centroid beside it."""
    return ((x - centroids) ** 2).sum(axis=1)


def loosening(before: np.ndarray, after: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """By how much any other centroid can have come nearer to a cluster's vectors.

    ``radius`` bounds the distance of each cluster's vectors from its old centroid.
    """
    a, b = before.astype(np.float64), after.astype(np.float64)
    move = np.sqrt(((b - a) ** 2).sum(axis=1))
    toward = (b - a) / np.maximum(move, 1e-300)[:, None]
    middle = (a + b) / 2
    out = np.zeros(len(a))
    for i in range(len(a)):
        to = a[i] - middle
        far = np.sqrt((to**2).sum(axis=1))
        seen = far > radius[i] * (1 + SLACK)  # the midpoint lies outside the sphere
        far = np.maximum(far, 1e-300)
        angle = np.arccos(np.clip((to * toward).sum(axis=1) / far, -1, 1))
        angle -= np.arcsin(np.clip(radius[i] / far, 0, 1))
        nearer = np.where(seen, move * np.cos(np.clip(angle, 0, np.pi / 2)), move)
        nearer[i] = 0
        out[i] = nearer.max()
    return out * (1 + SLACK) + SLACK * move.max(initial=0) * (out > 0)


@dataclass
class Move:
    """What a round knows of the last one: drifts and loosenings per cluster."""

    drift: np.ndarray
    loose: np.ndarray

    @staticmethod
    def of(before: np.ndarray, after: np.ndarray, radius: np.ndarray) -> Move:
        drift = np.sqrt(((after - before).astype(np.float64) ** 2).sum(axis=1)) * (1 + SLACK)
        return Move(drift, loosening(before, after, radius))


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid, and bounds of the distances to it and to the second one."""
    d = squared_distances(x, centroids)
    rows = np.arange(len(x))
    cluster = d.argmin(axis=1)
    upper = np.sqrt(d[rows, cluster]) * (1 + SLACK)
    if d.shape[1] == 1:
        return cluster, upper, np.full(len(x), np.inf)
    d[rows, cluster] = np.iinfo(np.int64).max
    return cluster, upper, np.sqrt(d.min(axis=1)) * (1 - SLACK)


def reassign(x, cluster, upper, lower, centroids: np.ndarray, move: Move) -> int:
    """Move bounds and clusters in place; returns how many rows met all centroids."""
    upper += move.drift[cluster]
    lower -= move.loose[cluster]
    rows = np.flatnonzero(upper >= lower)
    own = own_distances(x[rows], centroids[cluster[rows]])
    upper[rows] = np.sqrt(own) * (1 + SLACK)
    rows = rows[upper[rows] >= lower[rows]]
    if len(rows):
        cluster[rows], upper[rows], lower[rows] = nearest(x[rows], centroids)
    return len(rows)


def _round(centroids: np.ndarray, move: Move | None, components: int, scale: float):
    """Assign all vectors of a task and tally them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        sums, counts = np.zeros((k, components), np.int64), np.zeros(k, np.int64)
        radius, compared, seen = np.zeros(k), 0, False
        for batch in batches:
            if move is None:
                ids, x = scaled(batch, components, scale)
                if not len(x):
                    continue
                vectors = packed(x)
                cluster, upper, lower = nearest(x, centroids)
                compared += len(x)
            else:
                ids, vectors = batch.column(0), batch.column(1)
                x = unpacked(vectors, components)
                cluster, upper, lower = (batch.column(i).to_numpy().copy() for i in (2, 3, 4))
                compared += reassign(x, cluster, upper, lower, centroids, move)
            seen = True
            np.add.at(sums, cluster, x)
            counts += np.bincount(cluster, minlength=k)
            np.maximum.at(radius, cluster, upper)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.cast(pa.int64()), vectors.cast(pa.binary()),
                    pa.array(cluster.astype(np.int32)), pa.array(upper), pa.array(lower),
                    pa.nulls(len(ids), pa.binary()),
                ],
                names=["vec_id", "vector", "cluster", "upper", "lower", "tally"],
            )
        if seen:
            tally = b"".join(
                a.tobytes() for a in (np.array([compared], np.int64), counts, radius, sums)
            )
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(1, t) for t in kinds), pa.array([tally], pa.binary())],
                names=["vec_id", "vector", "cluster", "upper", "lower", "tally"],
            )

    return run


def _totals(k: int, components: int):
    """Rows (cluster, place, total, radius) of tallies; place -1 holds the count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cluster = np.tile(np.arange(k, dtype=np.int32), components + 1)
        place = np.repeat(np.arange(-1, components, dtype=np.int32), k)
        for batch in batches:
            for tally in batch.column(0).to_pylist():
                compared = np.frombuffer(tally, np.int64, 1)[0]
                counts = np.frombuffer(tally, np.int64, k, 8)
                radius = np.frombuffer(tally, np.float64, k, 8 + 8 * k)
                sums = np.frombuffer(tally, np.int64, offset=8 + 16 * k).reshape(k, components)
                once = np.zeros(len(cluster), np.int64)
                once[0] = compared
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cluster), pa.array(place),
                        pa.array(np.concatenate([counts, sums.T.ravel()])),
                        pa.array(np.tile(radius, components + 1)), pa.array(once),
                    ],
                    names=["cluster", "place", "total", "radius", "compared"],
                )

    return run


@dataclass
class Clusters:
    """Vectors with ``vec_id``, ``cluster`` and ``distance``; the final centroids; and
    how many vectors were compared with all centroids in each round."""

    vectors: DataFrame
    centroids: np.ndarray
    compared: list[int]


def start(vectors: DataFrame, clusters: int, components: int, scale: float, seed: str) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``<seed>:<vec_id>``, in that order."""
    x = F.col("embedding")
    whole = (F.size(x) == components) & F.forall(
        x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))
    )
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = (
        vectors.filter(whole).withColumn("name", name)
        .orderBy(F.asc_nulls_last("name"), "embedding").limit(clusters)
        .select("vec_id", "embedding").collect()
    )
    x = np.floor(scale * np.array([r.embedding for r in first], np.float64).reshape(-1, components))
    _refuse_large(np.abs(x).max(initial=0), components)
    return x.astype(np.int64)


def cluster_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", clusters: int = 16,
    rounds: int = 3, components: int = 64, scale: float = 64.0, seed: str = "1",
) -> Clusters:
    """Assign vectors to centroids that move ``rounds`` times.

    Components become floor(scale * x); a non-empty centroid moves to the floor of its
    vectors' exact mean.  After the last move all vectors are assigned once more.
    """
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding")
    )
    centroids = start(rows, clusters, components, scale, seed)
    k, move, compared, table = len(centroids), None, [], rows
    if not k:
        empty = rows.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long")
        return Clusters(empty, centroids, [0] * (rounds + 1))
    for number in range(rounds + 1):
        table = materialize(
            table.mapInArrow(_round(centroids, move, components, scale), _STATE), f"clusters-{number}"
        )
        totals = (
            table.filter("tally IS NOT NULL").select("tally")
            .mapInArrow(_totals(k, components), _TOTALS)
            .groupBy("cluster", "place")
            .agg(
                F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
                F.max("radius").alias("radius"), F.sum("compared").alias("compared"),
            )
            .collect()  # clusters * (components + 1) rows
        )
        compared.append(sum(r.compared for r in totals))
        table = table.filter("tally IS NULL").drop("tally")
        if number == rounds:
            break
        found = {(r.cluster, r.place): r for r in totals}
        moved, radius = centroids.copy(), np.zeros(k)
        for c in range(k):
            n = int(found[c, -1].total)
            radius[c] = found[c, -1].radius
            if n:
                moved[c] = [int(found[c, p].total) // n for p in range(components)]
        move, centroids = Move.of(centroids, moved, radius), moved
    return Clusters(_with_distance(table, centroids), centroids, compared)


def _with_distance(table: DataFrame, centroids: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster = batch.column(2).to_numpy()
            x = unpacked(batch.column(1), centroids.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(own_distances(x, centroids[cluster]))],
                names=["vec_id", "cluster", "distance"],
            )

    return table.mapInArrow(run, "vec_id long, cluster int, distance long")


def inertia_report(found: Clusters) -> DataFrame:
    """Each vector with its cluster's inertia, that of all, and its centroid's digest."""
    spark = found.vectors.sparkSession
    digests = [
        (i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for i, c in enumerate(found.centroids.tolist())
    ]
    names = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    sums = found.vectors.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    everything = sums.agg(F.sum("cluster_inertia"))
    # One row per cluster: their number is a parameter.
    per_cluster = sums.join(names, "cluster").withColumn("inertia", everything.scalar())
    return found.vectors.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
