"""Centroid clustering with Ptolemaic pivot bounds.

Vectors become integers, so that distances, sums and means are exact and no result depends on how
the rows are dealt. Centroids start as the vectors of smallest hash; each round assigns every vector
to its nearest centroid and moves the centroids to the floored means.

Ptolemy's inequality holds among any four points x, c, p, s of a Euclidean space:
d(x, c) d(p, s) >= |d(x, p) d(c, s) - d(x, s) d(c, p)|. The pivots p, s are fixed (the first starts), so
the distances of a vector to them are computed once and stored beside it; a round computes only the
centroids' own distances to the pivots. The bound of every pivot pair then excludes centroids: a
vector is compared exactly with the centroid of least bound, and after it with those whose bound does
not exceed the best distance found. Bounds are lowered by more than their rounding error, and a
centroid goes only if its bound is strictly above the best distance, so neither the nearest nor a tie
is ever lost. ``Clustering.assigned`` also tells how many exact comparisons each vector took.

A round is one pass that sends one row of sums per task and cluster; the driver holds the centroids
and nothing that grows with the table. The vectors are written once, with their pivot distances.

Defined cases: vectors of another length, with a null, non-finite or (times the scale) infinite
component are left out; a null vec_id is kept and becomes a start after all others only; rows that
repeat a vec_id are vectors of their own, and their order as starts is that of their components; fewer
vectors than clusters start as many clusters as there are; no vectors give no rows. Components are
exact at any size; a distance or inertia beyond the largest long is given as that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollwise.llm.staging import staged

DIMS = 64
CLUSTERS = 16
ROUNDS = 3
SCALE = 64
SEED = "1"
PIVOTS = 6

#: Far above the rounding of the few operations behind a bound.
_SLACK = 2.0**-44
#: Up to this size of components, squared distances are exact in a double (64 dimensions).
_EXACT = 2.0**22
_LIMB = 40
_MOST = 2**63 - 1


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _small(points: np.ndarray, others: list[list[int]]) -> bool:
    """Whether a double holds every squared distance between the two exactly."""
    most = max(np.abs(points).max(initial=0), max(abs(x) for other in others for x in other))
    return most <= _EXACT * (DIMS / max(DIMS, points.shape[1])) ** 0.5


def _squared(points: np.ndarray, other: list[int]) -> np.ndarray:
    """Exact squared distances of points to one point; Python integers where a double cannot hold them."""
    if _small(points, [other]):
        apart = points - np.array(other, np.float64)
        return np.einsum("ij,ij->i", apart, apart)
    out = np.empty(len(points), object)
    out[:] = [sum((int(x) - y) ** 2 for x, y in zip(row, other)) for row in points.tolist()]
    return out


def _root(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64))


def lower_bounds(to_pivots: np.ndarray, centroid_pivots: np.ndarray, pairs: list[tuple[int, int, float]]) -> np.ndarray:
    """Lower bounds of the distances between vectors and centroids, from their distances to pivots."""
    low = np.zeros((len(to_pivots), len(centroid_pivots)))
    for p, s, apart in pairs:
        left = np.multiply.outer(to_pivots[:, p], centroid_pivots[:, s])
        right = np.multiply.outer(to_pivots[:, s], centroid_pivots[:, p])
        np.maximum(low, (np.abs(left - right) - (left + right) * _SLACK) / apart, out=low)
    return low * (1 - _SLACK)


def nearest(points: np.ndarray, to_pivots: np.ndarray, centroids: list[list[int]], centroid_pivots: np.ndarray, pairs: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid of each vector (ties: the smaller number), its squared distance, and how many were compared."""
    low = lower_bounds(to_pivots, centroid_pivots, pairs)
    squares = low * low * (1 - _SLACK)
    label = low.argmin(1)
    best = np.empty(len(points), np.float64 if _small(points, centroids) else object)
    for c in np.unique(label).tolist():
        rows = np.flatnonzero(label == c)
        best[rows] = _squared(points[rows], centroids[c])
    first, compared = label.copy(), np.ones(len(points), np.int64)
    for c in range(len(centroids)):
        rows = np.flatnonzero((squares[:, c] <= best.astype(np.float64) * (1 + _SLACK)) & (first != c))
        found = _squared(points[rows], centroids[c])
        compared[rows] += 1
        closer = (found < best[rows]) | ((found == best[rows]) & (c < label[rows]))
        best[rows[closer]], label[rows[closer]] = found[closer], c
    return label, best, compared


def _limbs(sums: np.ndarray) -> Iterator[list[int]]:
    """Signed base-2**40 digits of integers, so that they can be summed as longs."""
    rest = [int(x) for x in sums]
    while True:
        last = all(-(1 << _LIMB) < x < 1 << _LIMB for x in rest)
        yield rest if last else [x & ((1 << _LIMB) - 1) for x in rest]
        if last:
            return
        rest = [x >> _LIMB for x in rest]


class Clustering:
    """The moving part of a run: centroids, as lists of integers, over stored vectors."""

    def __init__(self, vectors: DataFrame, starts: np.ndarray, pivots: int, scale: float):
        self.centroids = [[int(x) for x in start] for start in starts]
        self.pivots = self.centroids[:pivots]
        apart = np.stack([_root(_squared(starts[:pivots], p)) for p in self.pivots])
        self.pairs = [(p, s, float(apart[p, s])) for p, s in combinations(range(len(self.pivots)), 2) if apart[p, s] > 0]
        own, dims = self.pivots, len(self.centroids[0])

        def stored(batches):
            for batch in batches:
                points = np.floor(_matrix(batch.column("embedding"), dims) * scale)
                cached = np.stack([_root(_squared(points, p)) for p in own], 1)
                lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64())) for x in (points, cached)]
                yield pa.record_batch([batch.column("vec_id"), *lists], ["vec_id", "point", "to_pivots"])

        schema = T.StructType([vectors.schema["vec_id"], *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("point", "to_pivots")]])
        self.points = staged(vectors.mapInArrow(stored, schema), "points")

    def _assign(self):
        centroids, pairs, pivots, dims = self.centroids, self.pairs, self.pivots, len(self.centroids[0])
        near = [[_root(np.array([sum((x - y) ** 2 for x, y in zip(c, p))], object))[0] for p in pivots] for c in centroids]
        centroid_pivots = np.array(near)

        def assign(batch):
            points = _matrix(batch.column("point"), dims)
            cached = _matrix(batch.column("to_pivots"), len(pivots))
            return points, *nearest(points, cached, centroids, centroid_pivots, pairs)

        return assign

    def move(self) -> None:
        """One round: floored means of the assigned vectors; a centroid without any stays."""
        assign, k, dims = self._assign(), len(self.centroids), len(self.centroids[0])

        def sums(batches):
            total, n = np.zeros((k, dims), object), [0] * k
            for batch in batches:
                points, label, _, _ = assign(batch)
                for c in np.unique(label).tolist():
                    own = points[label == c]
                    if np.abs(own).max() > _EXACT:
                        total[c] += np.array([sum(map(int, x)) for x in own.T.tolist()], object)
                    else:
                        total[c] += own.sum(0).astype(np.int64).astype(object)
                    n[c] += len(own)
            rows = [(c, j, n[c] if j == 0 else 0, limb) for c in range(k) if n[c] for j, limb in enumerate(_limbs(total[c]))]
            if rows:
                yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))], ["cluster", "limb", "n", "sums"])

        partial = self.points.mapInArrow(sums, "cluster int, limb int, n long, sums array<long>")
        added = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dims)]
        count, total = [0] * k, [[0] * dims for _ in range(k)]
        for row in partial.groupBy("cluster", "limb").agg(F.sum("n").alias("n"), *added).collect():  # a few rows per cluster
            count[row.cluster] += row.n
            for i in range(dims):
                total[row.cluster][i] += row[f"s{i}"] << (_LIMB * row.limb)
        for c in range(k):
            if count[c]:
                self.centroids[c] = [x // count[c] for x in total[c]]

    def assigned(self) -> DataFrame:
        """vec_id, cluster, squared distance and number of exact comparisons of every vector."""
        assign = self._assign()

        def rows(batches):
            for batch in batches:
                _, label, best, compared = assign(batch)
                distance = pa.array([min(int(x), _MOST) for x in best.tolist()], pa.int64())
                yield pa.record_batch([batch.column("vec_id"), pa.array(label.astype(np.int32)), distance, pa.array(compared)], ["vec_id", "cluster", "distance", "compared"])

        tail = T.StructType.fromDDL("cluster int, distance long, compared long")
        return self.points.mapInArrow(rows, T.StructType([self.points.schema["vec_id"], *tail.fields]))


def start_clusters(embeddings: DataFrame, clusters: int = CLUSTERS, dims: int = DIMS, scale: float = SCALE, seed: str = SEED, pivots: int = PIVOTS) -> Clustering | None:
    """Vectors of ``embeddings`` (vec_id, embedding) stored as integers, and the starts; None without vectors."""
    vectors = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).filter(
        f"size(embedding) = {dims} AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x * {float(scale)}D) < double('Infinity'))"
    )
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    starts = vectors.select(order.alias("order"), "embedding").orderBy(F.asc_nulls_last("order"), "embedding").limit(clusters).collect()
    if not starts:
        return None
    return Clustering(vectors, np.floor(np.array([r.embedding for r in starts]) * scale), pivots, scale)


def centroid_clusters(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: float = SCALE, seed: str = SEED, pivots: int = PIVOTS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each kept vector."""
    run = start_clusters(embeddings, clusters, dims, scale, seed, pivots)
    if run is None:
        none = embeddings.select("vec_id").filter("false")
        return none.selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256")
    for _ in range(rounds):
        run.move()
    found = staged(run.assigned(), "assigned")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()  # one row per cluster
    inertia = {r.cluster: int(r.total) for r in sums}
    of_cluster = [min(inertia.get(c, 0), _MOST) for c in range(len(run.centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in run.centroids]

    def by_cluster(values: list) -> F.Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("cluster") + 1)

    return found.select(
        "vec_id",
        "cluster",
        "distance",
        by_cluster(of_cluster).cast("long").alias("cluster_inertia"),
        F.lit(min(sum(inertia.values()), _MOST)).cast("long").alias("inertia"),
        by_cluster(digests).alias("centroid_sha256"),
    )
