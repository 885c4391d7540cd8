"""Centroid clustering in whole numbers, with centroids filtered by N-simplex projection.

Distances to a few pivots are measured once and turned into the apex of a simplex over the pivots: its first coordinates
are the place of the vector in the pivots' own space, its last the distance from it. Of two apexes, the Euclidean distance
is a lower bound of the distance of the vectors; with the last coordinates on opposite sides it is an upper one. A
centroid whose lower bound lies above the smallest upper bound cannot be the nearest and is not compared; the others are
compared in whole numbers, so results are exact and the same in every order of work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.words import lean
from pagemill.session import written

#: Components are held between these bounds, which keeps a squared distance of up to 256 of them within a long.
LARGEST = 1 << 26
#: Bounds are given way by this share of the squared distances to the pivots, far beyond what rounding can do.
SLACK = 1e-5


def squared_distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances, a column for each point."""
    out = np.empty((len(rows), len(points)), np.int64)
    for i, point in enumerate(points):
        gap = rows - point
        out[:, i] = np.einsum("ij,ij->i", gap, gap)
    return out


class Simplex:
    """Apex coordinates over pivots, from distances alone."""

    def __init__(self, candidates: np.ndarray, pivots: int):
        """Farthest-first among the candidates; one that adds no dimension to those before it is no pivot."""
        self.pivots = candidates[:1].copy()
        self.vertices = np.zeros((1, 0))
        gaps = squared_distances(candidates, self.pivots)
        while len(candidates) and len(self.pivots) < pivots:
            best = int(gaps.min(axis=1).argmax())
            apex = self.apexes(gaps[best : best + 1])[0]
            if apex[-1] ** 2 <= 1e-3 * gaps.max():
                break
            self.vertices = np.vstack([np.hstack([self.vertices, np.zeros((len(self.vertices), 1))]), apex])
            self.pivots = np.vstack([self.pivots, candidates[best]])
            gaps = np.hstack([gaps, squared_distances(candidates, candidates[best : best + 1])])

    def apexes(self, squared: np.ndarray) -> np.ndarray:
        """Coordinates of the apex of each row of squared distances to the pivots; the last is not negative."""
        squared = squared.astype(np.float64)
        out = np.zeros(squared.shape)
        for i in range(1, len(self.vertices)):
            vertex = self.vertices[i, :i]
            along = (squared[:, 0] - squared[:, i] + vertex @ vertex) / 2
            out[:, i - 1] = (along - out[:, : i - 1] @ vertex[:-1]) / vertex[-1]
        if out.shape[1]:
            out[:, -1] = np.sqrt(np.maximum(squared[:, 0] - (out[:, :-1] ** 2).sum(axis=1), 0))
        return out

    def project(self, rows: np.ndarray) -> np.ndarray:
        return self.apexes(squared_distances(rows, self.pivots))


def bounds(apexes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared lower and upper bounds of the distances, a column for each of the others."""
    flat = sum(((apexes[:, i : i + 1] - others[:, i]) ** 2 for i in range(apexes.shape[1] - 1)), np.zeros((len(apexes), len(others))))
    one, two = apexes[:, -1:], others[:, -1]
    return flat + (one - two) ** 2, flat + (one + two) ** 2


class Nearest:
    """Assigns rows to the nearest of some centroids; of equally near ones to the one with the smallest number."""

    def __init__(self, centroids: np.ndarray, simplex: Simplex):
        self.centroids, self.apexes = centroids, simplex.project(centroids)

    def possible(self, apexes: np.ndarray) -> np.ndarray:
        """Which centroids each row may be nearest to."""
        low, high = bounds(apexes, self.apexes)
        slack = SLACK * ((apexes**2).sum(axis=1)[:, None] + (self.apexes**2).sum(axis=1) + 1)
        return low - slack <= (high + slack).min(axis=1)[:, None]

    def assign(self, rows: np.ndarray, apexes: np.ndarray, exact: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Centroid of each row, its squared distance and the number of centroids compared.

        Without ``exact``, a row that only one centroid is possible for is not compared and has no distance (-1).
        """
        possible = self.possible(apexes)
        compared = possible.sum(axis=1)
        cluster, distance = possible.argmax(axis=1), np.full(len(rows), -1)
        open_rows = np.ones(len(rows), bool) if exact else compared > 1
        for i, centroid in enumerate(self.centroids):
            at = np.flatnonzero(possible[:, i] & open_rows)
            found = squared_distances(rows[at], centroid[None])[:, 0]
            nearer = (distance[at] < 0) | (found < distance[at])
            cluster[at[nearer]], distance[at[nearer]] = i, found[nearer]
        return cluster, distance, compared


def whole_vectors(vectors: DataFrame, key: str, vector: str, dimensions: int, scale: int) -> DataFrame:
    """``key, q``: the components times ``scale``, rounded down, of vectors of so many components, none null or not finite."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    kept = vectors.filter(F.col(vector).isNotNull() & (F.size(vector) == dimensions) & sound)
    limit = F.lit(float(LARGEST))
    q = F.transform(vector, lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale).cast("double"), limit), -limit).cast("int"))
    return kept.select(F.col(key).alias("key"), q.alias("q"))


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def with_apexes(rows: DataFrame, simplex: Simplex, kind: str) -> DataFrame:
    """``key, q, apex``: the distances to the pivots are measured here and never again."""

    def projected(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in lean(parts):
            if part.num_rows:
                apexes = simplex.project(_matrix(part.column(1), np.int64))
                offsets = np.arange(len(apexes) + 1, dtype=np.int32) * apexes.shape[1]
                yield pa.record_batch([part.column(0), part.column(1), pa.ListArray.from_arrays(offsets, apexes.ravel())], ["key", "q", "apex"])

    return rows.mapInArrow(projected, f"key {kind}, q array<int>, apex array<double>")


def cluster_sums(rows: DataFrame, nearest: Nearest, dimensions: int) -> tuple[dict[int, tuple[int, list[int]]], float]:
    """Rows and exact component sums of every centroid that has any, and how many centroids were compared per row.

    A task passes on a number per centroid and component.
    """

    def summed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(nearest.centroids), dimensions + 2), np.int64)  # the last: rows and comparisons
        for part in lean(parts):
            if part.num_rows:
                q = _matrix(part.column(0), np.int64)
                cluster, _, compared = nearest.assign(q, _matrix(part.column(1), np.float64), exact=False)
                for i in np.unique(cluster):
                    own = q[cluster == i]
                    sums[i, -2:] += len(own), compared[cluster == i].sum()
                    sums[i, :-2] += own.sum(axis=0)
        cluster, place = np.nonzero(np.ones_like(sums) * (sums[:, -2:-1] > 0))
        yield pa.record_batch([pa.array(cluster.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(sums[cluster, place])], ["cluster", "place", "s"])

    partial = rows.select("q", "apex").mapInArrow(summed, "cluster int, place int, s long")
    total = partial.groupBy("cluster", "place").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # a row per centroid and component
    found: dict[int, list[int]] = {}
    for row in total:
        found.setdefault(row["cluster"], [0] * (dimensions + 2))[row["place"]] = int(row["s"])
    comparisons = sum(own[-1] for own in found.values()) / max(sum(own[-2] for own in found.values()), 1)
    return {i: (own[-2], own[:-2]) for i, own in found.items()}, comparisons


def assigned_rows(rows: DataFrame, nearest: Nearest, kind: str) -> DataFrame:
    """``key, cluster, distance, compared``."""

    def assigned(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in lean(parts):
            if part.num_rows:
                cluster, distance, compared = nearest.assign(_matrix(part.column(1), np.int64), _matrix(part.column(2), np.float64), exact=True)
                yield pa.record_batch([part.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance), pa.array(compared.astype(np.int32))], ["key", "cluster", "distance", "compared"])

    return rows.mapInArrow(assigned, f"key {kind}, cluster int, distance long, compared int")


def cluster_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", clusters: int = 8, rounds: int = 10, dimensions: int = 64, scale: int = 1024, salt: str = "3:", pivots: int = 8, renew_above: float = 2.0,
) -> tuple[DataFrame, list[list[int]]]:
    """Per kept vector: key, ``cluster``, ``distance``, ``compared`` (centroids that the bounds left over); and the centroids.

    Kept are vectors of ``dimensions`` components, none null or not finite, as whole numbers ``floor(scale * x)`` (held
    within ``LARGEST``). The first centroids are the vectors of the ``clusters`` smallest sha256 of salt and key (a null
    key as no text; equal ones by their components); fewer vectors make fewer clusters. A round assigns all vectors and
    moves every centroid that has any to their componentwise ``floor(sum / count)``. Rows that repeat a key are vectors
    of their own. Without kept vectors the result is empty.

    Pivots are centroids, as bounds are sharp for what lies in the pivots' own space. Once centroids have moved so far from
    it that more than ``renew_above`` of them are left over per vector, they become the pivots and distances are cached
    anew; what is assigned does not depend on it. There is at least one round.
    """
    kind = vectors.schema[key].dataType.simpleString()
    whole = whole_vectors(vectors, key, vector, dimensions, scale)
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    first = whole.select("q", digest.alias("digest")).orderBy("digest", "q").limit(clusters).collect()
    centroids = np.array([row["q"] for row in first], np.int64).reshape(-1, dimensions)
    compared = np.inf
    for _ in range(max(rounds, 1)):
        if compared > renew_above:
            simplex = Simplex(centroids, pivots)
            cached = written(with_apexes(whole, simplex, kind), "apexes")
        sums, compared = cluster_sums(cached, Nearest(centroids, simplex), dimensions)
        for i, (n, own) in sums.items():
            centroids[i] = [s // n for s in own]
    found = assigned_rows(cached, Nearest(centroids, simplex), kind)
    return found.withColumnRenamed("key", key), centroids.tolist()


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Add ``cluster_inertia`` and ``inertia``, the squared distances summed by cluster and over all, and ``centroid_sha256``."""
    assigned = written(assigned, "clusters")
    sums = {r["cluster"]: int(r["d"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}  # a row per centroid
    most = (1 << 63) - 1
    every = min(sum(sums.values()), most)
    rows = [(i, min(d, most), every, hashlib.sha256(",".join(map(str, centroids[i])).encode()).hexdigest()) for i, d in sums.items()]
    totals = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(totals), "cluster")
