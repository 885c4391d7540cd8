"""Centroid clustering against plain whole numbers, and the bounds that filter centroids."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm.simplex_clusters import LARGEST, Nearest, Simplex, bounds, cluster_vectors, squared_distances, with_inertia

SCHEMA = "vec_id long, embedding array<float>, label int, q string, apex string, cluster string, distance string"


def plain(rows, clusters=8, rounds=10):
    """Loops over Python's own numbers."""
    kept = [(k, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for k, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    kept = [(k, [max(-LARGEST, min(LARGEST, x)) for x in v]) for k, v in kept]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:clusters]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for i, own in groups.items():
            centroids[i] = [sum(x) // len(own) for x in zip(*own)]
    return sorted(((k if k is not None else -1), *nearest(v)[::-1]) for k, v in kept), centroids


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 0, "a", "b", "c", "d") for k, v in rows], SCHEMA)


def same(spark, rows, **settings):
    found, centroids = cluster_vectors(frame(spark, rows), **settings)
    got = sorted((-1 if r["vec_id"] is None else r["vec_id"], r["cluster"], r["distance"]) for r in found.collect())
    want, want_centroids = plain(rows, settings.get("clusters", 8))
    assert got == want
    assert centroids == want_centroids
    return found, centroids


def drawn(seed, n, groups=5, spread=0.3):
    draw = np.random.default_rng(seed)
    middle = draw.normal(0, 1, (groups, 64))
    return [(i, (middle[i % groups] + draw.normal(0, spread, 64)).astype(np.float32).tolist()) for i in range(n)]


def test_plain_numbers(spark):
    found, centroids = same(spark, drawn(1, 300))
    rows = with_inertia(found, centroids).collect()
    assert {r["inertia"] for r in rows} == {sum(r["distance"] for r in rows)}
    for r in rows:
        assert r["cluster_inertia"] == sum(x["distance"] for x in rows if x["cluster"] == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()


def test_no_groups_and_few_pivots(spark):
    same(spark, drawn(2, 120, groups=120, spread=1.0), pivots=3)


def test_odd_rows(spark):
    rows = drawn(3, 40)
    vector = rows[0][1]
    rows += [(5, vector), (5, vector), (None, vector), (None, rows[1][1]), (100, None), (101, []), (102, vector[:63]), (103, [*vector[:63], None])]
    rows += [(104, [*vector[:63], float("nan")]), (105, [*vector[:63], float("-inf")]), (106, [1e30] * 64), (107, [-1e30] * 64), (108, [0.0] * 64)]
    same(spark, rows)


def test_ties_and_one_hot_vector(spark):
    one, two = [0.5] * 64, [-0.25] * 64
    same(spark, [(i, one if i % 3 else two) for i in range(60)])


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5] * 64)], [(i, [float(i)] * 64) for i in range(5)]])
def test_fewer_vectors_than_clusters(spark, rows):
    found, centroids = same(spark, rows)
    assert with_inertia(found, centroids).count() == sum(v is not None for _, v in rows)


def test_bounds_hold():
    draw = np.random.default_rng(4)
    points = draw.integers(-2000, 2000, (200, 64))
    for pivots in (1, 2, 5, 9):
        simplex = Simplex(points[:20], pivots)
        assert len(simplex.pivots) == pivots
        low, high = bounds(simplex.project(points[20:]), simplex.project(points[:20]))
        exact = squared_distances(points[20:], points[:20])
        assert (low <= exact * (1 + 1e-9) + 1e-3).all() and (high >= exact * (1 - 1e-9) - 1e-3).all()


def test_pivots_that_add_no_dimension_are_left_out():
    line = np.outer(np.arange(6), np.ones(64, np.int64))
    assert len(Simplex(line, 4).pivots) == 2


def test_centroids_are_filtered(spark):
    found, _ = cluster_vectors(frame(spark, drawn(6, 400, groups=8, spread=0.05)))
    assert found.agg(F.avg("compared")).first()[0] < 2


def test_nearest_of_equals_is_the_first():
    centroids = np.array([[0] * 4, [2, 0, 0, 0], [2, 0, 0, 0]])
    nearest = Nearest(centroids, Simplex(centroids, 2))
    rows = np.array([[1, 0, 0, 0], [2, 0, 0, 0], [1, 5, 5, 5]])
    cluster, distance, _ = nearest.assign(rows, nearest_apexes(nearest, centroids, rows), True)
    assert cluster.tolist() == [0, 1, 0] and distance.tolist() == [1, 0, 76]


def nearest_apexes(nearest, centroids, rows):
    return Simplex(centroids, 2).project(rows)
