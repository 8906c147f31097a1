"""Whitening against exact arithmetic and a plain solver."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest

from tabloom.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, n string, whitened int"


def spaces_equal(a, b, tolerance):
    return np.abs(a @ a.T - b @ b.T).max() < tolerance


def residual(matrix, values, x):
    a, x = matrix.astype(np.longdouble), x.astype(np.longdouble)
    return float(np.abs(a @ x - x * values).max() / max(np.abs(matrix).max(), 1e-300)), float(np.abs(x.T @ x - np.eye(len(matrix))).max())


def rotated(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))).astype(np.longdouble).astype(float))[0]
    matrix = q @ np.diag(values) @ q.T
    return (matrix + matrix.T) / 2


@pytest.mark.parametrize(
    "values",
    [
        [5.0, 3.0, 2.0, 1.0, 0.5, 0.25],
        # A cluster that float32 cannot resolve, one of multiples, and a wide range.
        [1.0, 1.0 - 1e-9, 1.0 - 2e-9, 0.5, 0.5 + 1e-11, 1e-6],
        [1.0, 1.0, 1.0, 0.25, 0.25, 1e-12],
        [1e6, 1.0, 1.0 - 1e-8, 1e-3, 1e-9, 0.0],
        [0.0] * 4,
        [2.0],
    ],
)
def test_eigenvectors_to_double_precision(values):
    matrix = rotated(np.array(values))
    found, x = whitening.eigen(matrix)
    assert list(found) == sorted(found, reverse=True)
    off, orthogonal = residual(matrix, found, x)
    assert off < 5e-16 and orthogonal < 1e-15
    plain = np.linalg.eigh(matrix)[0][::-1]
    assert np.allclose(found, plain, atol=1e-13 * max(1.0, abs(plain[0])))


def test_cluster_is_resolved():
    """Eigenvalues 1e-9 apart: each vector is right by itself, not only their common space."""
    diagonal = np.diag([1.0, 1.0 - 1e-9, 1.0 - 3e-9, 0.5])
    turn = np.eye(4)
    turn[:2, :2] = [[0.8, -0.6], [0.6, 0.8]]  # products of these are exact up to the last digit
    found, x = whitening.eigen(turn @ diagonal @ turn.T)
    for k in range(4):
        assert np.abs(np.abs(x[:, k]) - np.abs(turn[:, k])).max() < 1e-6


def brute(rows, components=8):
    usable = [(v, e) for v, e in rows if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in e] for _, e in usable]
    n, dims = len(x), len(x[0])
    sums = [sum(column) for column in zip(*x, strict=True)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(row, sums, strict=True)] for row in x])
    matrix = np.array([[float(np.dot(centred[:, i], centred[:, j])) / n for j in range(dims)] for i in range(dims)])
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values)[:components]
    out = {}
    for (v, _), row, c in zip(usable, x, centred, strict=True):
        deviation = sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True))
        for k, at in enumerate(order):
            out[v, k + 1] = (n, deviation, abs(float(c @ vectors[:, at])) / np.sqrt(values[at]), values[at] / matrix.trace())
    return out


def test_equals_plain_computation(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(c) for c in rng.normal(size=12) * np.arange(1, 13) / 6]) for k in range(120)]
    rows += [(120, None), (121, [1.0] * 11 + [None]), (122, [float("nan")] * 12), (123, [float("inf")] + [0.0] * 11), (124, rows[0][1])]
    wanted = brute(rows)
    rows += [(125, []), (126, [1.0, 2.0]), (127, [1e35] + [0.0] * 11)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(7)
    found = whitening.whitened(table).collect()
    assert len(found) == len(wanted)
    errors = {r["identity_error"] for r in found}
    assert len(errors) == 1 and errors.pop() < 1e-12
    for r in found:
        n, deviation, value, explained = wanted[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(abs(r["whitened"]) - value) < 1e-9 and abs(r["explained"] - explained) < 1e-9


def test_null_and_repeated_ids_few_and_constant_vectors(spark):
    def run(rows):
        return whitening.whitened(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect()

    assert run([]) == [] and run([(1, None), (2, [])]) == []
    one = run([(1, [0.5, 0.25])])
    assert [tuple(r) for r in sorted(one, key=lambda r: r["component"])] == [(1, k, 1, 0, None, None, None) for k in (1, 2)]
    # One direction: the second component is nothing but rounding.
    flat = run([(None, [0.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [2.0, 2.0])])
    assert sorted((r["vec_id"] is None, r["component"], r["whitened"] is None) for r in flat).count((False, 2, True)) == 3
    assert all(r["identity_error"] < 1e-12 for r in flat)


def test_deviation_beyond_a_long():
    fit = whitening.Fit(2, 3_000_000_000, (0, 1))
    x = np.array([[1, 0], [2, 0], [3_000_000, 5]], np.int64)
    exact = [sum((fit.n * int(c) - s) ** 2 for c, s in zip(row, fit.sums, strict=True)) for row in x]
    assert fit.deviations(x) == [e if e < 1 << 63 else None for e in exact]


def test_query_over_its_table(spark, sf_dir):
    rows = queries.op11_embedding_whitening(spark, sf_dir).collect()
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    wanted = brute([(r["vec_id"], r["embedding"]) for r in vectors])
    assert len(rows) == 8 * len(vectors)
    for r in rows:
        n, deviation, value, explained = wanted[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(abs(r["whitened"]) - value) < 1e-7 and abs(r["explained"] - explained) < 1e-9 and r["identity_error"] < 1e-10
