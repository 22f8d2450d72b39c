"""Connected components by alternating star contraction.

Every round keeps the edges few: an edge list is first shrunk inside each
partition to one star per local component, then large-star and small-star steps
pull each node to the smallest node it can see.  Rounds are written to the shared
folder, so an executor that is lost costs one round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import materialize

#: A node with fewer edges is never treated as frequent.
LEAST_HOT = 1000
_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest member of each of ``n`` nodes' component, for index pairs."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        while True:
            hop = new[new]
            if (hop == new).all():
                break
            new = hop
        if (new == label).all():
            return label
        label = new[label]


def star_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest one of its component among these edges."""
    nodes, codes = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = roots(len(nodes), codes[: len(a)], codes[len(a) :])
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def _shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (batch.column(i).to_numpy() for i in (0, 1))
        a, b = star_edges(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=_EDGE)


def _with_least(edges: DataFrame, neighbours: DataFrame, hot: int) -> DataFrame:
    """Edges with ``m``, the smallest of ``neighbours``' b at the edge's ``a``.

    A centre with more than ``hot`` edges is looked up in a broadcast: there are at most
    as many such centres as edges / ``hot``.  So no task gets all edges of one centre.
    """
    least = neighbours.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
    centres = least.filter(F.col("n") > hot).select("a", F.col("m").alias("hot_m"))
    marked = edges.join(F.broadcast(centres), "a", "left")
    rest = marked.filter("hot_m IS NULL").drop("hot_m").join(
        least.filter(F.col("n") <= hot).select("a", "m"), "a"
    )
    return rest.unionByName(marked.filter("hot_m IS NOT NULL").withColumnRenamed("hot_m", "m"))


def _large_star(edges: DataFrame, hot: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    found = _with_least(both.filter("b > a"), both, hot)
    return found.select(F.col("b").alias("a"), F.least("m", "a").alias("b")).filter("a <> b")


def _small_star(edges: DataFrame, hot: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    moved = _with_least(down, down, hot).filter("b <> m").select(
        F.col("b").alias("a"), F.col("m").alias("b")
    )
    least = down.groupBy("a").agg(F.min("b").alias("b"))
    return moved.unionByName(least).distinct()


def components(edges: DataFrame, hot: int | None = None) -> DataFrame:
    """Columns ``node``, ``component`` (the smallest node) of all nodes with edges.

    ``edges`` has BIGINT columns ``a`` and ``b`` without NULLs.  Nodes whose only
    edges are loops do not appear.  A node with more than ``hot`` edges (an even share
    per task, if not given) is treated as described in ``_with_least``.  Rounds go on
    until nothing changes; every round before that pulls some node to a smaller one.
    """
    tasks = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stars = materialize(edges.select("a", "b").mapInArrow(_shrink, "a long, b long"), "stars")
    state, size = None, stars.count()
    while True:
        limit = hot or max(LEAST_HOT, 2 * size // tasks)
        stars = materialize(_small_star(_large_star(stars, limit), limit), "stars")
        now = tuple(
            stars.agg(
                F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
            ).first()
        )
        if now == state:
            break
        state, size = now, now[0]
    centres = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)
