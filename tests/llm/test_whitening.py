"""Whitening against a dense eigendecomposition, and its defined results."""

from __future__ import annotations

import math

import numpy as np
import pytest

from millrace.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component int, x string"


def by_force(rows, k=4):
    """(n, sums, centred, vectors, values) of the rows (id, floats)."""
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for _, v in rows], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    z = fit - sums / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    return x, n, sums, values[::-1][:k], vectors[:, ::-1][:, :k], np.trace(z.T @ z / n)


def check(got, rows, k=4):
    x, n, sums, values, vectors, trace = by_force(rows, k)
    by_key = {(r.vec_id, r.component): r for r in got}
    assert len(got) == len(rows) * len(values)
    sign = {}
    for (vec_id, _), own in zip(rows, x):
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(own, sums))
        for c, value in enumerate(values):
            row = by_key[vec_id, c + 1]
            assert row.n == n and row.deviation == deviation and row.identity_error < 1e-9
            assert abs(row.explained - value / trace) < 1e-12 and row.residual < 1e-13 * max(values)
            expected = (own - sums / n) @ vectors[:, c] / math.sqrt(value)
            if abs(expected) > 1e-3:
                sign.setdefault(c, math.copysign(1, expected * row.whitened))
            assert abs(row.whitened * sign.get(c, 1) - expected) < 1e-8


@pytest.mark.parametrize("size,count", [(24, 600), (3, 40), (1, 9), (64, 30)])
def test_against_dense(spark, size, count):
    r = np.random.default_rng(size)
    vectors = (r.standard_normal((count, size)) * np.linspace(2, 0.5, size)).astype(np.float32)
    vectors[5:8] = vectors[4]  # equal vectors count once in the fit
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    odd = [(900, None), (901, []), (902, [float("nan")] * size), (903, [float("inf")] * size), (904, [None] * size), (905, [1.0] * (size + 2))]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows + odd], SCHEMA).repartition(3)
    check(whitening.whitened(frame).collect(), rows)


def test_partial_sums_are_merged(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MOST_PARTS", 2)
    x = spark.range(0, 50, 1, 5).selectExpr("array(id, -id, cast(pow(2, 61) as bigint) + id) x")
    n, sums = whitening.moments(x)
    assert (n, sums) == (50, [1225, -1225, 50 * 2**61 + 1225])


def test_empty_and_flat_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert whitening.whitened(none).count() == 0
    one = spark.createDataFrame([(1, [1.0, 2.0], 1, "x"), (1, [1.0, 2.0], 1, "x")], SCHEMA)
    assert whitening.whitened(one).count() == 0
    line = spark.createDataFrame([(i, [float(i), float(i)], 1, "x") for i in range(6)] + [(None, [2.0, 2.0], 1, "x")], SCHEMA)
    got = whitening.whitened(line).collect()  # variance along one direction only
    assert len(got) == 7 and {r.component for r in got} == {1} and {r.n for r in got} == {6}
    assert abs(np.var([r.whitened for r in got if r.vec_id is not None]) - 1) < 1e-12


def test_large_values(spark):
    rows = [(i, [float(np.float32(v)) for v in (1e30 * i, 1e10 + i * 1e5, -0.0)]) for i in range(5)]
    got = whitening.whitened(spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)).collect()
    assert got and all(r.deviation is None for r in got)
    rows = [(i, [1e5 * i, 3e4 * (i % 3)]) for i in range(300)]
    got = whitening.whitened(spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)).collect()
    _, n, sums, _, _, _ = by_force(rows)
    for r in got:
        exact = sum((n * math.floor(256 * v) - int(s)) ** 2 for v, s in zip(rows[r.vec_id][1], sums))
        assert r.deviation == (exact if exact < 1 << 63 else None)


def test_jacobi_davidson_on_hard_spectra():
    for trial in range(120):
        r = np.random.default_rng(trial)
        size = int(r.integers(1, 40))
        values = {0: np.ones(size), 1: np.arange(size) / 7, 2: 10.0 ** -np.arange(size), 3: np.r_[np.zeros(size // 2), r.random(size - size // 2)]}[trial % 4]
        basis, _ = np.linalg.qr(r.standard_normal((size, size)))
        matrix = (basis * values) @ basis.T
        got, vectors, residuals = whitening.jacobi_davidson(lambda b: matrix @ b, size, 4)
        assert np.allclose(got, np.sort(values)[::-1][:4], atol=1e-13 * max(values.max(), 1))
        assert np.allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-12) and residuals.max() <= 1e-13 * max(values.max(), 1e-300)


def test_minres_solves():
    r = np.random.default_rng(2)
    matrix = r.standard_normal((20, 20))
    matrix = matrix + matrix.T
    right = r.standard_normal((20, 3))
    got = whitening.minres(lambda b: matrix @ b, right, 60, 1e-13)
    assert np.allclose(matrix @ got, right, atol=1e-8)
