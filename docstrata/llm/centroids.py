"""Clustering around centroids, searched through a vantage-point tree.

Every round the driver builds a tree over the centroids and broadcasts it. Below a node
lie a vantage centroid and the others, split by their distance to it into a near and a far
half; a child knows the smallest and the largest distance of its centroids to the vantage.
Each vector visits the nodes best bound first: the triangle inequality bounds how close
any centroid of a child can be, and a child is left out only if that bound is beyond the
distance found so far, so an equally near centroid of a smaller number is always met. The
bounds are in floating point and rounded down; distances themselves are whole numbers.

A round sends one row per cluster and task, summed by Spark before the driver sees it: it
holds centroids and sums of centroids, never vectors.

Defined cases: vectors that are null, have another number of components, or hold a null or
a number that is not finite take no part; repeated rows and rows without id are vectors of
their own, but the latter start no centroid while others are left; with fewer vectors
than clusters there are fewer clusters, without vectors no rows; a cluster that loses all
vectors keeps its centroid; ties go to the smaller number. Sums and distances are exact for
any finite numbers; a distance or inertia beyond 64 bits is shown as the largest 64-bit
number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docstrata.llm.tables import Scratch, pick

CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
LEAF = 2
# Vectors searched at once, times nodes of the tree.
_TILE = 1 << 20
_LIMB = 31
_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Node:
    """A vantage centroid and what lies near and far, or the centroids of a leaf."""

    centroids: tuple[int, ...]
    children: tuple[tuple[int, float, float], ...] = ()


class VantageTree:
    """The nodes over the rows of a matrix of centroids; node 0 is the root.

    ``children`` holds the number of a node and the bounds of the distances (not squared)
    from the vantage to all that lies below it.
    """

    def __init__(self, centroids: np.ndarray, leaf: int = LEAF):
        self.centroids = centroids
        self.exact = centroids.dtype == object
        self.nodes: list[Node] = []
        self._build(list(range(len(centroids))), leaf)

    def _build(self, members: list[int], leaf: int) -> int:
        at = len(self.nodes)
        self.nodes.append(Node(tuple(members)))
        if len(members) <= max(1, leaf):
            return at
        vantage = members[0]
        squared = squares(self.centroids[members[1:]], self.centroids[vantage])
        order = sorted(range(len(squared)), key=lambda i: (squared[i], i))
        half = len(order) // 2
        children = []
        for part in (order[:half], order[half:]):
            if part:
                below = self._build([members[1 + i] for i in part], leaf)
                ends = (0.0, np.inf) if self.exact else (squared[part[0]] ** 0.5, squared[part[-1]] ** 0.5)
                children.append((below, *ends))
        self.nodes[at] = Node((vantage,), tuple(children))
        return at

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each vector and its squared distance."""
        step = max(1, _TILE // len(self.nodes))
        parts = [self._tile(vectors[low : low + step]) for low in range(0, len(vectors), step)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, self.centroids.dtype)
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))

    def _tile(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(vectors)
        # How close each node that is open may come, squared; others are infinite.
        bound = np.full((n, len(self.nodes)), np.inf)
        bound[:, 0] = 0
        number = np.full(n, len(self.centroids), np.int64)
        distance = np.zeros(n, self.centroids.dtype)
        radius = np.full(n, np.inf)
        rows = np.arange(n)
        while len(rows):
            node = bound[rows].argmin(axis=1)
            lowest = bound[rows, node]
            open_ = (lowest < np.inf) & (lowest <= radius[rows])
            rows, node, lowest = rows[open_], node[open_], lowest[open_]
            bound[rows, node] = np.inf
            for at in np.unique(node).tolist():
                here = node == at
                own = rows[here]
                squared = self._visit(at, vectors[own], own, number, distance, radius)
                for below, near, far in self.nodes[at].children:
                    bound[own, below] = np.maximum(lowest[here], self._bound(squared, near, far))
        return number, distance

    def _visit(self, at, vectors, own, number, distance, radius):
        for centroid in self.nodes[at].centroids:
            squared = squares(vectors, self.centroids[centroid])
            met = number[own] < len(self.centroids)
            nearer = ~met | (squared < distance[own])
            nearer |= met & (squared == distance[own]) & (centroid < number[own])
            nearer = nearer.astype(bool)
            number[own[nearer]] = centroid
            distance[own[nearer]] = squared[nearer]
            if not self.exact:
                radius[own[nearer]] = squared[nearer]
        return squared

    def _bound(self, squared: np.ndarray, near: float, far: float) -> np.ndarray | float:
        """No centroid between ``near`` and ``far`` of the vantage is closer; rounded down."""
        if self.exact:
            return 0.0
        own = np.sqrt(squared.astype(np.float64))
        apart = np.maximum(own - far, near - own) - 1e-9 * (own + near + 1)
        return np.maximum(apart, 0) ** 2 * (1 - 1e-9)


def squares(vectors: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Squared distances of rows to one vector, in whole numbers."""
    apart = vectors - centre
    return (apart * apart).sum(axis=1)


def quantise(values: np.ndarray, scale: int, exact: bool) -> np.ndarray:
    """floor(scale * x): 64-bit, or Python numbers where 64 bits are too few."""
    if not exact:
        return np.floor(values * scale).astype(np.int64)
    whole = [int(x) * scale if abs(x) >= 2**53 else int(np.floor(x * scale)) for x in values.ravel().tolist()]
    out = np.empty(len(whole), object)
    out[:] = whole
    return out.reshape(values.shape)


def _matrix(column: pa.Array, dimensions: int, scale: int, exact: bool) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return quantise(values.reshape(-1, dimensions), scale, exact)


def _limbs(number: int, limbs: int) -> list[int]:
    """A number in digits of 31 bits, lowest first, the last one signed."""
    low = [(number >> (_LIMB * i)) & ((1 << _LIMB) - 1) for i in range(limbs - 1)]
    return [*low, number >> (_LIMB * (limbs - 1))]


def _sums(tree, dimensions: int, scale: int, limbs: int):
    """Per task: a row (cluster, n, sums of the digits of all components) per cluster."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: VantageTree = tree.value
        k = len(index.centroids)
        count = np.zeros(k, np.int64)
        total = np.zeros((k, dimensions), index.centroids.dtype)
        for batch in batches:
            vectors = _matrix(batch["vector"], dimensions, scale, index.exact)
            nearest, _ = index.nearest(vectors)
            count += np.bincount(nearest, minlength=k)
            for cluster in np.unique(nearest).tolist():
                total[cluster] += vectors[nearest == cluster].sum(axis=0)
        rows = [c for c in range(k) if count[c]]
        digits = [[d for x in total[c].tolist() for d in _limbs(int(x), limbs)] for c in rows]
        columns = [
            pa.array(rows, pa.int32()),
            pa.array([int(count[c]) for c in rows], pa.int64()),
            pa.array(digits, pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "digits"])

    return sums


def _assigned(tree, dimensions: int, scale: int):
    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: VantageTree = tree.value
        for batch in batches:
            vectors = _matrix(batch["vector"], dimensions, scale, index.exact)
            nearest, squared = index.nearest(vectors)
            shown = [min(int(d), _LONG) for d in squared.tolist()]
            columns = [batch["vec_id"], pa.array(nearest.astype(np.int32)), pa.array(shown, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return assigned


def usable(vectors: DataFrame, dimensions: int) -> DataFrame:
    """vec_id and vector of the rows that take part."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = pick(vectors, "vec_id", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    return rows.where((F.size("vector") == dimensions) & finite)


def _digest(centroid) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def centroids(
    rows: DataFrame, dimensions: int, k: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED
) -> np.ndarray:
    """The centroids (k rows) of written rows (vec_id, vector) after all rounds."""
    spark = rows.sparkSession
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(order.asc_nulls_last(), "vector").limit(k).collect()
    largest = rows.agg(F.max(F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector"))))).first()[0]
    reach = int(largest or 0) * scale + scale
    # A difference of two components, squared and summed, has to stay below 2 ** 63.
    exact = 4 * reach * reach * dimensions >= 1 << 62
    limbs = -(-reach.bit_length() // _LIMB) + 1 if exact else 1
    centre = quantise(np.array([r["vector"] for r in first], np.float64).reshape(-1, dimensions), scale, exact)
    if not len(centre):
        return centre
    for _ in range(rounds):
        tree = spark.sparkContext.broadcast(VantageTree(centre))
        partial = rows.mapInArrow(
            _sums(tree, dimensions, scale, limbs), "cluster int, n bigint, digits array<bigint>"
        )
        # Digits of 31 bits leave room for the sums of four billion tasks; whole sums of
        # one task are below 2 ** 63 as long as it has fewer than 2 ** 32 vectors.
        wide = partial.select("cluster", "n", F.posexplode("digits").alias("at", "digit"))
        summed = wide.groupBy("cluster", "at").agg(
            F.sum("n").alias("n"), F.sum(F.col("digit").cast("decimal(38,0)")).alias("digit")
        )
        centre = centre.copy()
        totals: dict[int, list[int]] = {}
        counts: dict[int, int] = {}
        for r in summed.collect():
            total = totals.setdefault(r["cluster"], [0] * dimensions)
            total[r["at"] // limbs] += int(r["digit"]) << (_LIMB * (r["at"] % limbs))
            counts[r["cluster"]] = r["n"]
        for cluster, total in totals.items():
            centre[cluster] = [x // counts[cluster] for x in total]
        tree.unpersist()
    return centre


def cluster(
    vectors: DataFrame,
    dimensions: int = 64,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """vec_id, cluster and distance of every vector, with the inertia of its cluster and
    of all, and the digest of its final centroid."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "centroids")
    rows = scratch.write(usable(vectors, dimensions))
    centre = centroids(rows, dimensions, k, rounds, scale, seed)
    if not len(centre):
        empty = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], empty)
    tree = spark.sparkContext.broadcast(VantageTree(centre))
    found = scratch.write(
        rows.mapInArrow(_assigned(tree, dimensions, scale), "vec_id bigint, cluster int, distance bigint")
    )
    spent = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    shown = {r["cluster"]: min(int(r["d"]), _LONG) for r in spent}
    inertia = min(sum(int(r["d"]) for r in spent), _LONG)
    of = [(c, shown.get(c, 0), inertia, _digest(centre[c])) for c in range(len(centre))]
    about = spark.createDataFrame(of, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
