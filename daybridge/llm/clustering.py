"""Centroid clustering in exact integers: a vantage-point tree over the centroids finds each vector's nearest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybridge.llm.common import corpus_session, fresh, staged
from daybridge.llm.vectors import block_matrices, doubles, fits, integer_blocks, integer_rows, integers, largest

# Centroids of a leaf of the tree, compared all at once.
LEAF = 4

# Entries of a search's table of bounds: vectors searched at a time times nodes of the tree.
BOUNDS = 1 << 22

# Square roots are rounded; bounds give way by this part, so that rounding never prunes an equal distance.
SLACK = 1e-12


TOO_FAR = np.iinfo(np.int64).max


def squared_distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows: of doubles, which then hold every term, or of Python integers."""
    if x.dtype == np.float64:
        return ((x * x).sum(1)[:, None] - 2 * (x @ points.T) + (points * points).sum(1)).astype(np.int64)
    found = [[min(int(d), TOO_FAR) for d in ((x - p) ** 2).sum(1)] for p in points]
    return np.array(found, np.int64).reshape(len(points), len(x)).T


def _exact(*matrices: np.ndarray) -> list[np.ndarray]:
    """Integer matrices in the type that squared distances between them are exact in."""
    most = max(1, *map(largest, matrices))
    return [m.astype(np.float64 if fits(4 * m.shape[1], most, most) else object) for m in matrices]


@dataclass
class Node:
    """A vantage point with two halves by distance from it, or a leaf's points; numbers are places in the tree's points."""

    points: np.ndarray
    children: tuple[int, ...] = ()
    nearest: tuple[float, ...] = ()   # of each half, its least distance from the vantage point
    farthest: tuple[float, ...] = ()


class VantageTree:
    """The centroids in a vantage-point tree: small enough to broadcast, rebuilt whenever they move."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.nodes = points, []
        if len(points):
            self._build(_exact(points)[0], np.arange(len(points)), leaf)

    def _build(self, points: np.ndarray, members: np.ndarray, leaf: int) -> int:
        at = len(self.nodes)
        self.nodes.append(Node(members))
        if len(members) <= leaf:
            return at
        # the point farthest from the first sees the others at the most different distances
        first = squared_distances(points[members], points[members[:1]])[:, 0]
        vantage = members[int(np.argmax(first))]
        rest = members[members != vantage]
        far = np.sqrt(squared_distances(points[rest], points[vantage:vantage + 1])[:, 0].astype(np.float64))
        order = np.argsort(far, kind="stable")
        halves = [h for h in np.array_split(order, 2) if len(h)]  # by rank: equal points split as evenly as others
        children = tuple(self._build(points, rest[half], leaf) for half in halves)
        self.nodes[at] = Node(np.array([vantage]), children,
                              tuple(float(far[half].min()) * (1 - SLACK) for half in halves),
                              tuple(float(far[half].max()) * (1 + SLACK) for half in halves))
        return at

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of integer rows the number of the nearest point, the smallest of equally near ones, and the squared distance."""
        step = max(1, BOUNDS // max(1, len(self.nodes)))
        x, points = _exact(x, self.points)
        parts = [self._search(x[i:i + step], points) for i in range(0, len(x), step)] or [(np.empty(0, np.int64),) * 2]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _search(self, x: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best first: each row opens, of its own open nodes, the one with the least bound, until none can hold a
        point as near as its best. The rows that open the same node do so together."""
        number, exact = np.full(len(x), len(points), np.int64), np.full(len(x), TOO_FAR)
        best = np.full(len(x), np.inf)  # the root of the exact one, loosened
        bounds = np.full((len(x), len(self.nodes)), np.inf)
        bounds[:, 0] = 0
        active = np.arange(len(x))
        while True:
            opened = bounds[active].argmin(1)
            bound = bounds[active, opened]
            # inclusive: a node at exactly the best distance may hold an equally near point of a smaller number
            on = (bound <= best[active]) & np.isfinite(bound)
            active, opened = active[on], opened[on]
            if not len(active):
                if (exact == TOO_FAR).any():
                    raise OverflowError("a squared distance does not fit a long")
                return number, exact
            for at in np.unique(opened).tolist():
                rows, node = active[opened == at], self.nodes[at]
                found = squared_distances(x[rows], points[node.points])
                near = found.min(1)
                which = np.where(found == near[:, None], node.points, len(points)).min(1)
                better = (near < exact[rows]) | ((near == exact[rows]) & (which < number[rows]))
                number[rows[better]], exact[rows[better]] = which[better], near[better]
                best[rows] = np.where(exact[rows] < TOO_FAR, np.sqrt(exact[rows].astype(np.float64)) * (1 + SLACK), np.inf)
                parent = bounds[rows, at]
                bounds[rows, at] = np.inf
                if node.children:
                    far = np.sqrt(found[:, 0].astype(np.float64))
                    for child, lo, hi in zip(node.children, node.nearest, node.farthest):
                        bounds[rows, child] = np.maximum(
                            parent, np.maximum(lo - far * (1 + SLACK), far * (1 - SLACK) - hi))


@dataclass
class Clusters:
    """The centroids after the last round, and of each its vectors and the distances summed over them."""

    centroids: list[list[int]]
    sizes: list[int]
    inertias: list[int]

    @property
    def inertia(self) -> int:
        return sum(self.inertias)

    def digests(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids]


def _round(kept: DataFrame, centroids: list[list[int]], dimensions: int) -> Clusters:
    """All vectors assigned once; the sums of their components stand in ``centroids``."""
    shared = kept.sparkSession.sparkContext.broadcast(VantageTree(np.array(centroids, np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, sums = shared.value, {}
        for batch in batches:
            for x in block_matrices(batch, dimensions):
                number, distance = tree.nearest(x)
                if not fits(len(x), max(largest(x), largest(distance), 1)):
                    x, distance = x.astype(object), distance.astype(object)  # no sum overflows
                for n in np.unique(number).tolist():
                    own = number == n
                    found = [int(own.sum()), int(distance[own].sum()), *map(int, x[own].sum(0))]
                    sums[n] = [s + f for s, f in zip(sums.get(n, [0] * len(found)), found)]
        yield pa.record_batch([pa.array(list(sums), pa.int32()),
                               pa.array([list(map(str, s)) for s in sums.values()], pa.list_(pa.string()))], ["cluster", "sums"])

    found = (kept.mapInArrow(run, "cluster int, sums array<string>")
             .select("cluster", F.posexplode("sums").alias("place", "part"))
             .groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("sum")).collect())
    shared.unpersist()
    table = [[0] * (dimensions + 2) for _ in centroids]
    for r in found:
        table[r["cluster"]][r["place"]] = int(r["sum"])
    return Clusters([t[2:] for t in table], [t[0] for t in table], [t[1] for t in table])


def fit(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", *, dimensions: int = 64, scale: int = 64,
        clusters: int = 16, rounds: int = 3, salt: str = "1:") -> Clusters:
    """Centroids after ``rounds`` rounds, and the figures of one more assignment.

    The vectors are written once, as blocks of integers. A round is one pass over them: tasks return a sum for
    each of their clusters and dimensions, and the driver gets ``clusters * dimensions`` numbers.
    """
    corpus_session(vectors.sparkSession)
    named = vectors.select(F.col(f"`{id}`").alias("id"), F.col(f"`{vector}`").alias("vector"))
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = (integer_rows(named, "vector", dimensions, scale, 0, "id")
             .orderBy(key, F.col("id").isNull(), "x").limit(clusters).collect())
    kept = staged(integer_blocks(vectors, vector, dimensions, scale), "zstd") if first else None
    found = Clusters([list(r["x"]) for r in first], [], [])
    for _ in range(rounds if first else 0):
        told = _round(kept, found.centroids, dimensions)
        found.centroids = [[s // n for s in sums] if n else old
                           for old, sums, n in zip(found.centroids, told.centroids, told.sizes)]
    if first:
        told = _round(kept, found.centroids, dimensions)
        found.sizes, found.inertias = told.sizes, told.inertias
    return found


def assigned(centroids: list[list[int]], vector: str, dimensions: int, scale: int, spark) -> Column:
    """A struct of the nearest centroid's number and its squared distance; null for vectors that are not kept."""
    shared = spark.sparkContext.broadcast(VantageTree(np.array(centroids, np.int64).reshape(len(centroids), dimensions)))

    @F.arrow_udf("struct<number: int, distance: bigint>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows, x = integers(batch, dimensions, scale, 0)
            number, distance = (np.zeros(len(batch), np.int64) for _ in range(2))
            missing = np.ones(len(batch), bool)
            if len(rows):
                number[rows], distance[rows] = shared.value.nearest(x)
                missing[rows] = False
            yield pa.StructArray.from_arrays([pa.array(number.astype(np.int32)), pa.array(distance)],
                                             ["number", "distance"], mask=pa.array(missing))

    return run.asNondeterministic()(doubles(vector))


def cluster(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", *, dimensions: int = 64, scale: int = 64,
            clusters: int = 16, rounds: int = 3, salt: str = "1:") -> tuple[DataFrame, str, Clusters]:
    """The rows as they are with one more column, its name, and the clusters.

    The column is a struct: ``number`` of the nearest centroid (squared Euclidean distance, the smallest
    number of equally near ones) and ``distance``, squared. It is null for vectors that are null, have another
    number of entries than ``dimensions``, or hold a null, a NaN or an infinity; these take no part. Entries
    are floored after ``scale``; all arithmetic is exact.

    The first centroids are the vectors with the smallest SHA-256 of ``salt`` and the id (a null id is an empty
    text; of equal ids the smaller vector). A centroid becomes the floored mean of its vectors, and stays as it
    is without any. With fewer vectors than ``clusters`` each is a centroid; an empty table has none. Repeated
    rows count each time. An entry or distance that does not fit a long is an error.
    """
    found = fit(vectors, id, vector, dimensions=dimensions, scale=scale, clusters=clusters, rounds=rounds, salt=salt)
    name, = fresh(vectors, "cluster")
    if not found.centroids:
        return vectors.withColumn(name, F.lit(None).cast("struct<number: int, distance: bigint>")), name, found
    column = assigned(found.centroids, vector, dimensions, scale, vectors.sparkSession)
    return vectors.withColumn(name, column), name, found
