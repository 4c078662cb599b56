"""Embedding whitening: principal components by Golub-Kahan-Lanczos bidiagonalisation of the centred vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybridge.llm.common import corpus_session, fresh, staged
from daybridge.llm.vectors import block_matrices, doubles, finite_rows, fits, integer_blocks, integers, largest, matrix_of

# Sums of this many tasks are added in one, in the order of the tasks.
TASKS = 512

# A Ritz vector is done when what the next step could still change is below this part of the largest singular
# value; a direction this short is rounding.
TOLERANCE, TINY = 1e-14, 1e-12


@dataclass
class Centre:
    """Exact sums of integer vectors: the mean is ``(n * floor + rest) / n``, with ``0 <= rest < n``."""

    n: int
    sums: list[int]
    squares: list[int]

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    @property
    def trace(self) -> Fraction:
        """Of the covariance, with divisor n."""
        return Fraction(sum(self.n * q - s * s for s, q in zip(self.sums, self.squares)), self.n * self.n)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - mean`` as doubles: the whole part of the mean is taken off as an integer, so nothing cancels."""
        floors = np.array([s // self.n for s in self.sums], np.int64)
        return (x - floors).astype(np.float64) - np.array([s % self.n / self.n for s in self.sums])

    def deviations(self, x: np.ndarray) -> list[int]:
        """Of each row the sum of ``(n * x - sum) ** 2``, exactly at any n."""
        rest = [s % self.n for s in self.sums]
        u = x - np.array([s // self.n for s in self.sums], np.int64)
        most = max(1, largest(u))
        if not fits(len(rest), most, max(most, self.n)):
            u, r = u.astype(object), np.array(rest, object)
        else:
            r = np.array(rest, np.int64)
        ends = sum(v * v for v in rest)
        return [self.n * self.n * int(a) - 2 * self.n * int(b) + ends for a, b in zip((u * u).sum(1), (u * r).sum(1))]


@dataclass
class Whitening:
    """Unit components (rows) by falling variance, and what they explain; fewer than asked for where the vectors
    have no more directions."""

    centre: Centre
    components: np.ndarray
    variances: list[float]
    explained: list[float]
    identity_error: float
    passes: int


def _centre(kept: DataFrame, dimensions: int, offset: int) -> Centre:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, [0] * dimensions, [0] * dimensions
        for batch in batches:
            for x in block_matrices(batch, dimensions, offset):
                if not fits(len(x), max(1, largest(x)), max(1, largest(x))):
                    x = x.astype(object)
                n += len(x)
                sums = [a + int(b) for a, b in zip(sums, x.sum(0))]
                squares = [a + int(b) for a, b in zip(squares, (x * x).sum(0))]
        yield pa.record_batch([pa.array([list(map(str, [n, *sums, *squares]))], pa.list_(pa.string()))], ["sums"])

    rows = (kept.mapInArrow(run, "sums array<string>").select(F.posexplode("sums").alias("place", "part"))
            .groupBy("place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("sum")).collect())
    found = [int(r["sum"]) for r in sorted(rows)]
    return Centre(found[0], found[1:dimensions + 1], found[dimensions + 1:])


def _summed(kept: DataFrame, dimensions: int, offset: int, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all rows of what ``of`` gives for a block of them, ``size`` numbers.

    Rounded sums depend on their order, so tasks are added in the order of their numbers: reruns agree.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for x in block_matrices(batch, dimensions, offset):
                total += of(x)
        yield pa.record_batch([pa.array([TaskContext.get().partitionId()]), pa.array([total.tolist()])], ["task", "sums"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("task")
        return pa.table({"task": table["task"][:1], "sums": [matrix_of(table["sums"].combine_chunks(), size).sum(0).tolist()]})

    schema = "task bigint, sums array<double>"
    rows = (kept.mapInArrow(run, schema).groupBy(F.floor(F.col("task") / TASKS))
            .applyInArrow(add, schema).collect())
    return np.sum([r["sums"] for r in sorted(rows)], axis=0) if rows else np.zeros(size)


def _apart(x: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """x without its parts along orthonormal vectors: twice, which is enough."""
    for _ in range(2 if basis else 0):
        rows = np.array(basis)
        x = x - rows.T @ (rows @ x)
    return x


def bidiagonalise(normal: Callable[[np.ndarray], np.ndarray], dimensions: int, wanted: int,
                  scale: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Right singular vectors (rows) and singular values of a tall matrix A, and the passes over it.

    ``normal(p)`` is ``A'(Ap)``: one pass computes a block of the left vector ``Ap`` and takes it back
    through the block's transpose. Left vectors are as long as A has rows; each is ``A p`` for a short p, so p
    and ``A'u`` stand for it, and ``u_j'w = p_j'(A'w)`` takes it out of a later one. Both sides are
    reorthogonalised against all before them, twice. ``scale`` is a norm of A to judge rounding by.
    """
    rng = np.random.default_rng(0)

    def another(basis):
        x = _apart(rng.standard_normal(dimensions), basis)
        return x / np.linalg.norm(x)

    right, left, back, alphas, betas = [another([])], [], [], [], []
    p = right[0]
    for step in range(1, dimensions + 1):
        z = normal(p)
        for _ in range(2 if left else 0):
            share = np.array(left) @ z
            p, z = p - np.array(left).T @ share, z - np.array(back).T @ share
        alpha = float(np.sqrt(max(p @ z, 0.0)))
        if alpha <= TINY * scale:  # A maps this direction to where it has been: a left vector of zeros
            alpha, p, z = 0.0, np.zeros(dimensions), np.zeros(dimensions)
        else:
            p, z = p / alpha, z / alpha
        left.append(p)
        back.append(z)
        alphas.append(alpha)
        after = _apart(z - alpha * right[-1], right)
        beta = float(np.linalg.norm(after))
        if beta <= TINY * scale:
            beta = 0.0
        u, values, v = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
        open_ends = beta * np.abs(u[-1, :wanted])
        if step == dimensions or (beta > 0 and step >= wanted and (open_ends <= TOLERANCE * values[0]).all()):
            break
        # an invariant subspace ends in zero; what lies outside is searched from another start
        right.append(after / beta if beta else another(right))
        betas.append(beta)
        p = right[-1] - beta * p
    return v @ np.array(right), values, step


def _length(vectors: DataFrame, vector: str) -> int:
    """The number of entries that most finite vectors have; the larger of equally frequent ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        for batch in batches:
            _, edges, whole = finite_rows(batch.column(0))
            for length, n in zip(*np.unique(np.diff(edges)[whole], return_counts=True)):
                counts[int(length)] = counts.get(int(length), 0) + int(n)
        yield pa.record_batch([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["length", "n"])

    found = (vectors.select(doubles(vector).alias("x")).mapInArrow(run, "length bigint, n bigint")
             .groupBy("length").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("length")).first())
    return found["length"] if found else 0


def fit(vectors: DataFrame, vector: str = "embedding", components: int = 8, scale: int = 1024,
        offset: int = 100_000) -> Whitening | None:
    """Components of all finite vectors of the prevailing length; None without any entry."""
    corpus_session(vectors.sparkSession)
    d = _length(vectors, vector)
    if not d:
        return None
    kept = staged(integer_blocks(vectors, vector, d, scale), "zstd")
    centre = _centre(kept, d, offset)

    def normal(p: np.ndarray) -> np.ndarray:
        def product(x: np.ndarray) -> np.ndarray:
            rows = centre.centred(x)
            return rows.T @ (rows @ p)
        return _summed(kept, d, offset, product, d)

    trace = float(centre.trace)
    if not trace:
        return Whitening(centre, np.zeros((0, d)), [], [], 0.0, 0)
    found, values, passes = bidiagonalise(normal, d, min(components, d), (trace * centre.n) ** 0.5)
    real = [i for i in range(min(components, d, len(values))) if values[i] > 1e-6 * values[0]]
    unit = found[real] / np.linalg.norm(found[real], axis=1)[:, None]
    variances = [float(values[i]) ** 2 / centre.n for i in real]
    told = Whitening(centre, unit, variances, [e / trace for e in variances], 0.0, passes)
    k = len(real)

    def moments(x: np.ndarray) -> np.ndarray:
        w = whitened(told, x)
        return np.r_[w.sum(0), (w.T @ w).ravel()]

    sums = _summed(kept, d, offset, moments, k + k * k) / centre.n
    covariance = sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k])
    told.identity_error = float(np.abs(covariance - np.eye(k)).max())
    return told


def whitened(model: Whitening, x: np.ndarray) -> np.ndarray:
    """Integer rows centred, projected on the components and divided by their deviations."""
    return model.centre.centred(x) @ model.components.T / np.sqrt(model.variances)


def _applied(model: Whitening, vector: str, scale: int, offset: int, spark) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<deviation: decimal(38,0), entries: array<double>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        for batch in batches:
            rows, x = integers(batch, known.centre.dimensions, scale, offset)
            deviation, entries, missing = [None] * len(batch), [None] * len(batch), np.ones(len(batch), bool)
            missing[rows] = False
            if len(rows):
                for row, told, w in zip(rows.tolist(), known.centre.deviations(x), whitened(known, x).tolist()):
                    deviation[row], entries[row] = Decimal(told), w
            yield pa.StructArray.from_arrays([pa.array(deviation, pa.decimal128(38, 0)), pa.array(entries, pa.list_(pa.float64()))],
                                             ["deviation", "entries"], mask=pa.array(missing))

    return run.asNondeterministic()(doubles(vector))


def whiten(vectors: DataFrame, vector: str = "embedding", components: int = 8, scale: int = 1024,
           offset: int = 100_000) -> tuple[DataFrame, str, Whitening | None]:
    """The rows as they are with one more column, its name, and the model.

    Entries become ``floor(scale * entry) + offset``. The column is a struct: ``deviation``, the sum over
    dimensions of ``(n * x - S) ** 2`` for n vectors with sums S, exact; and ``entries``, the centred vector
    projected on each component, over the component's standard deviation. Null for vectors that are null, hold
    a null, a NaN or an infinity, or have another number of entries than most; these take no part. Equal and
    repeated rows count each time and get equal values.

    Components without variance have no whitening and are left out, so there may be fewer than asked for: none
    of equal vectors, none of a single one. Without any vector, or of vectors without entries, the model is None.
    """
    model = fit(vectors, vector, components, scale, offset)
    name, = fresh(vectors, "whitened")
    kind = "struct<deviation: decimal(38,0), entries: array<double>>"
    if model is None:
        return vectors.withColumn(name, F.lit(None).cast(kind)), name, None
    return vectors.withColumn(name, _applied(model, vector, scale, offset, vectors.sparkSession)), name, model
