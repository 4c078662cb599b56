import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybridge.llm.queries import QUERIES
from daybridge.llm.whitening import Centre, bidiagonalise, whiten


def _plain(rows, k, scale=1024, offset=100_000):
    """Exact deviations, and whitened values from the eigenvectors of the exact covariance."""
    x = [[math.floor(scale * c) + offset for c in v] for v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    scaled = [[n * a - s for a, s in zip(r, sums)] for r in x]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in scaled), n ** 3)) for j in range(d)] for i in range(d)])
    values, unit = np.linalg.eigh(cov)
    values, unit = values[::-1][:k], unit.T[::-1][:k]
    centred = np.array([[c / n for c in r] for r in scaled])
    return deviation, centred @ unit.T / np.sqrt(values), values / np.trace(cov)


def _agree(found, want):
    signs = np.sign((found * want).sum(0))
    assert np.abs(found * signs - want).max() < 1e-9


@pytest.mark.parametrize("rows,columns,rank,falling", [
    (300, 64, 64, 0), (300, 64, 64, 5), (300, 64, 5, 0), (30, 64, 30, 0), (50, 1, 1, 0), (50, 9, 9, 1), (8, 8, 8, 7)])
def test_bidiagonalisation(rows, columns, rank, falling):
    rng = np.random.default_rng(rows + columns)
    a = rng.standard_normal((rows, columns)) * np.logspace(0, -falling, columns)
    if rank < min(rows, columns):
        a = rng.standard_normal((rows, rank)) @ rng.standard_normal((rank, columns))
    right, values, passes = bidiagonalise(lambda p: a.T @ (a @ p), columns, min(8, columns), float(np.linalg.norm(a)))
    _, true, vectors = np.linalg.svd(a, full_matrices=False)
    for i in range(min(8, rank, columns)):
        if true[i] > 1e-6 * true[0]:
            assert abs(values[i] / true[i] - 1) < 1e-10
            gap = min(abs(true[i] ** 2 - t ** 2) for j, t in enumerate(true) if j != i) / true[0] ** 2 if len(true) > 1 else 1
            assert abs(abs(right[i] @ vectors[i]) - 1) < 1e-13 / gap
    assert passes <= columns and np.abs(right @ right.T - np.eye(len(right))).max() < 1e-13


def test_fewer_passes_when_converged():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((400, 200)) * np.logspace(0, -8, 200)
    assert bidiagonalise(lambda p: a.T @ (a @ p), 200, 4, float(np.linalg.norm(a)))[2] < 60


def test_exact_deviations_beyond_a_long():
    centre = Centre(10**9, [10**14 + 7, -(10**14) - 9], [0, 0])
    x = np.array([[100_001, -99_999], [3, 2**40]])
    assert centre.deviations(x) == [sum((10**9 * int(a) - s) ** 2 for a, s in zip(r, centre.sums)) for r in x]


def test_query_against_plain_version(spark, sf):
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    ids = sorted(rows)
    deviation, entries, explained = _plain([rows[i] for i in ids], 8)
    found = {}
    for r in QUERIES["op12_embedding_whitening"](spark, sf).collect():
        found[r.vec_id, r.component] = r
    assert set(found) == {(i, c) for i in ids for c in range(1, 9)}
    assert all(found[i, c].deviation == d and found[i, c].n == len(ids) for i, d in zip(ids, deviation) for c in (1, 8))
    _agree(np.array([[found[i, c].whitened for c in range(1, 9)] for i in ids]), entries)
    assert all(abs(found[ids[0], c].explained / e - 1) < 1e-10 for c, e in enumerate(explained, 1))
    assert len({r.identity_error for r in found.values()}) == 1 and found[ids[0], 1].identity_error < 1e-10
    again = {(r.vec_id, r.component): r.whitened for r in QUERIES["op12_embedding_whitening"](spark, sf).collect()}
    assert again == {k: r.whitened for k, r in found.items()}


def test_hostile(spark):
    rows = [(i, [math.sin(i), math.cos(3 * i), i / 10]) for i in range(20)] + [(3, [math.sin(3), math.cos(9), 0.3])] * 3
    odd = [(100, None), (101, []), (102, [1.0]), (103, [1.0, None, 2.0]), (104, [float("nan"), 0.0, 0.0]),
           (105, [0.0, float("-inf"), 0.0]), (106, [1.0, 2.0, 3.0, 4.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + odd], "vec_id long, embedding array<double>, whitened string, n int").repartition(4)
    found, name, model = whiten(df)
    assert found.columns == [*df.columns, name] and model.centre.n == len(rows)
    told = found.collect()
    assert {r.vec_id for r in told if r[name] is None} == {i for i, _ in odd}
    kept = sorted((r for r in told if r[name]), key=lambda r: r.vec_id)
    deviation, entries, _ = _plain([r.embedding for r in kept], 8)
    assert [int(r[name].deviation) for r in kept] == deviation
    _agree(np.array([r[name].entries for r in kept]), entries)


@pytest.mark.parametrize("rows", [[], [None], [[]], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_nothing_to_whiten(spark, rows):
    found, name, model = whiten(spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "vec_id long, embedding array<float>"))
    kept = [r[name] for r in found.collect() if r[name]]
    assert len(kept) == sum(bool(r) for r in rows) and all(r.deviation == 0 and r.entries == [] for r in kept)
    assert (model is None) == (not kept)


def test_one_direction(spark):
    df = spark.createDataFrame([(i, [i / 1024, -2 * i / 1024]) for i in range(9)], "vec_id long, embedding array<double>")
    found, name, model = whiten(df)
    assert len(model.components) == 1 and abs(model.explained[0] - 1) < 1e-12
    values = [r[name].entries[0] for r in found.orderBy("vec_id").collect()]
    assert all(abs(abs(v) - abs(i - 4) / math.sqrt(60 / 9)) < 1e-9 for i, v in enumerate(values))
    assert found.where(F.col(name).isNull()).count() == 0
