"""Vector columns as exact integer matrices: what clustering and whitening share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Magnitude below which a scaled entry is taken; it has to become a long.
LONGS = float(1 << 62)

# Entries of a block of vectors, about: half a megabyte in narrow integers.
BLOCK_ENTRIES = 1 << 18


def doubles(vector: str) -> Column:
    """A numeric array column as doubles, which hold any float exactly."""
    return F.col(f"`{vector}`").cast("array<double>")


def finite_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a list column: all entries in one array, where each row starts and ends in it (``n + 1`` edges), and
    which rows are neither null nor hold a null, a NaN or an infinity."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    edges = np.r_[0, np.cumsum(lengths)]
    odd = np.r_[0, np.cumsum(~np.isfinite(entries))]
    whole = (odd[edges[1:]] == odd[edges[:-1]]) & pc.is_valid(column).to_numpy(zero_copy_only=False)
    return entries, edges, whole


def integers(column: pa.Array, dimensions: int, scale: int, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of ``dimensions`` finite entries, and these as ``floor(scale * entry) + offset``, one row each.

    An entry whose integer is beyond a long is an error, not a wrong number.
    """
    entries, edges, whole = finite_rows(column)
    rows = np.flatnonzero(whole & (np.diff(edges) == dimensions))
    found = entries[(edges[rows, None] + np.arange(dimensions)).ravel()] * scale
    if len(found) and np.abs(found).max() >= LONGS:
        raise OverflowError(f"an entry times {scale} does not fit a long")
    return rows, np.floor(found).astype(np.int64).reshape(len(rows), dimensions) + offset


def lists(matrix: np.ndarray) -> pa.Array:
    """A matrix as a list column, one list a row."""
    n, d = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(matrix.ravel()))


def matrix_of(column: pa.Array, dimensions: int) -> np.ndarray:
    """A list column of equal lengths, without nulls, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimensions)


def integer_rows(df: DataFrame, vector: str, dimensions: int, scale: int, offset: int, *beside: str) -> DataFrame:
    """The rows kept, as columns ``beside`` and ``x``, an array of longs."""
    kept = df.select(*[F.col(f"`{c}`") for c in beside], doubles(vector).alias("x"))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]], "x array<bigint>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = integers(batch.column(batch.num_columns - 1), dimensions, scale, offset)
            kept = [batch.column(i).take(pa.array(rows)) for i in range(batch.num_columns - 1)]
            yield pa.record_batch([*kept, lists(found)], names=batch.schema.names)

    return kept.mapInArrow(run, schema)


def integer_blocks(df: DataFrame, vector: str, dimensions: int, scale: int) -> DataFrame:
    """The rows kept as ``floor(scale * entry)``, in blocks of some thousand: ``(width, x)``, the bytes of an entry
    and the block's entries in the narrowest integers that hold them.

    Iterative operators write this once and read it in every pass: a fraction of the bytes of the vectors, and
    one value for Spark to hand on where there were thousands of arrays.
    """
    most = max(1, BLOCK_ENTRIES // dimensions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def block() -> pa.RecordBatch:
            x = np.concatenate(held)
            width = next(w for w in (1, 2, 4, 8) if largest(x) < 1 << 8 * w - 1)
            return pa.record_batch([pa.array([width], pa.int32()), pa.array([x.astype(f"<i{width}").tobytes()])], ["width", "x"])

        for batch in batches:
            held.append(integers(batch.column(0), dimensions, scale, 0)[1])
            size += len(held[-1])
            if size >= most:
                yield block()
                held, size = [], 0
        if size:
            yield block()

    return df.select(doubles(vector).alias("x")).mapInArrow(run, "width int, x binary")


def block_matrices(batch: pa.RecordBatch, dimensions: int, offset: int = 0) -> Iterator[np.ndarray]:
    """The blocks of a batch as matrices of longs."""
    for width, x in zip(batch.column("width").to_pylist(), batch.column("x")):
        yield np.frombuffer(x.as_buffer(), f"<i{width}").astype(np.int64).reshape(-1, dimensions) + offset


def fits(*factors: float) -> bool:
    """Whether a product of magnitudes is below 2^53, so that doubles hold it and every smaller sum exactly."""
    return float(np.prod([float(f) for f in factors])) < 2.0 ** 53


def largest(matrix: np.ndarray) -> int:
    return max(int(matrix.max()), -int(matrix.min())) if matrix.size else 0
