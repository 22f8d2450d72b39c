"""Clusters against plain Python, and the geometric bound against brute force."""

import hashlib
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quern.llm import clustering
from quern.llm.shipping import ship

KIND = "vec_id long, embedding array<float>, cluster string, tally string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def whole(vector, components):
    return vector is not None and len(vector) == components and all(
        x is not None and math.isfinite(x) for x in vector
    )


def expected(rows, components, clusters=4, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if whole(v, components)]

    def rank(item):
        i, v = item
        name = None if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest()
        return name is None, name or "", v

    centroids = [list(v) for _, v in sorted(kept, key=rank)[:clusters]]

    def nearest(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        own = [nearest(v)[0] for _, v in kept]
        for c in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, own) if o == c]
            if mine:
                centroids[c] = [sum(column) // len(mine) for column in zip(*mine)]
    return Counter((i, *nearest(v)) for i, v in kept), centroids


def run(spark, rows, components, clusters=4):
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], KIND)
    return clustering.cluster_vectors(frame, clusters=clusters, components=components)


def blobs(n, components, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (6, components))
    return [
        (i, [float(x) for x in np.float32(centres[i % 6] + rng.normal(0, 0.2, components))])
        for i in range(n)
    ]


@pytest.mark.parametrize("components", [2, 8])
def test_equals_plain_rounds(spark, components):
    rows = blobs(300, components, components)
    found = run(spark, rows, components)
    want, centroids = expected(rows, components)
    assert Counter(tuple(r) for r in found.vectors.collect()) == want
    assert found.centroids.tolist() == centroids
    # Bounds spare most vectors the comparison with all centroids.
    assert found.compared[0] == 300 and sum(found.compared[1:]) < 3 * 300 / 2


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (None, [-3.0, 2.0]), (None, [-3.0, 2.5]),
        (3, None), (4, []), (5, [1.0]), (6, [1.0, 2.0, 3.0]), (7, [None, 1.0]), (8, [nan, 1.0]),
        (9, [inf, 1.0]), (10, [-inf, 1.0]), (11, [0.0, -0.0]), (12, [1000.0, -1000.0]),
        (13, [0.25, 0.75]), (13, [0.75, 0.25]),
    ]
    for clusters in (1, 3, 40):
        want, _ = expected(rows, 2, clusters)
        found = run(spark, rows, 2, clusters)
        assert Counter(tuple(r) for r in found.vectors.collect()) == want


def test_empty_table(spark):
    found = run(spark, [(3, None)], 2)
    assert clustering.inertia_report(found).count() == 0
    assert run(spark, [], 2).compared == [0, 0, 0, 0]


def test_report(spark):
    rows = blobs(60, 2, 9)
    found = run(spark, rows, 2)
    report = clustering.inertia_report(found).collect()
    want, centroids = expected(rows, 2)
    inertia = Counter()
    for (_, c, d), n in want.items():
        inertia[c] += d * n
    for r in report:
        assert (r.cluster_inertia, r.inertia) == (inertia[r.cluster], sum(inertia.values()))
        text = ",".join(map(str, centroids[r.cluster]))
        assert r.centroid_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        run(spark, [(1, [3e30, 0.0]), (2, [0.0, 0.0])], 2).vectors.collect()


def test_wide_integers_are_exact():
    x = np.array([[2**27 - 1, -(2**27)], [0, 3]], np.int64)
    c = np.array([[-(2**27), 2**27 - 1], [1, 1]], np.int64)
    exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, k)) for k in c] for r in x]
    assert clustering.squared_distances(x, c).tolist() == exact
    assert clustering.unpacked(clustering.packed(x), 2).tolist() == x.tolist()


def test_loosening_holds_and_is_below_the_drift():
    rng = np.random.default_rng(7)
    gained = 0
    for _ in range(200):
        k, d = rng.integers(2, 6), rng.integers(2, 5)
        before = rng.normal(0, 50, (k, d))
        after = before + rng.normal(0, rng.choice([1, 20]), (k, d))
        radius = rng.uniform(0, 40, k)
        loose = clustering.loosening(before, after, radius)
        drift = np.sqrt(((after - before) ** 2).sum(axis=1))
        for i in range(k):
            step = rng.normal(0, 1, (400, d))
            step *= (radius[i] * rng.uniform(0, 1, (400, 1)) ** 0.2) / np.linalg.norm(step, axis=1)[:, None]
            x = before[i] + step
            nearer = np.linalg.norm(x[:, None] - before, axis=2) - np.linalg.norm(x[:, None] - after, axis=2)
            nearer[:, i] = 0
            assert nearer.max() <= loose[i]
            most = np.delete(drift, i).max()
            assert loose[i] <= most * (1 + 1e-6)
            gained += loose[i] < 0.9 * most
    assert gained > 50


def test_mixed_widths_are_unpacked_together():
    small, large = clustering.packed(np.array([[1, -2]])), clustering.packed(np.array([[300, -70000]]))
    both = pa.concat_arrays([small, large, small])
    assert clustering.unpacked(both, 2).tolist() == [[1, -2], [300, -70000], [1, -2]]
