"""Whitening against the library eigensolver, with ties, copies and odd vectors."""

import math
import random

import numpy as np
import pytest

from gleaner.llm import whitening as w


def frame(spark, data, kind="vec_id long, embedding array<float>"):
    return spark.createDataFrame(data, kind)


def run(spark, data, most=16):
    rows = w.integer_rows(frame(spark, data), "vec_id", "embedding")
    return w.whiten(rows, w.fit(rows, most)).collect()


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40])
def test_solver_equals_library(n):
    random_ = np.random.default_rng(n)
    a = random_.standard_normal((n, n))
    for matrix in (a @ a.T, a @ a.T * 1e-9, np.eye(n), np.diag(np.arange(n) // 2).astype(float), np.ones((n, n))):
        values, vectors = w.leading_components(matrix, n)
        expected = np.linalg.eigvalsh(matrix)[::-1]
        scale = max(abs(expected).max(), 1e-290)
        assert np.abs(values - expected).max() <= 1e-13 * scale * n
        assert np.abs(vectors @ vectors.T - np.eye(n)).max() < 1e-12
        assert np.abs(vectors @ matrix - values[:, None] * vectors).max() <= 1e-12 * scale * n


def test_sturm_counts():
    diagonal, off = np.array([2.0, -1.0, 0.5, 3.0]), np.array([1.0, 0.0, 0.25])
    values = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
    points = np.linspace(-3, 5, 41) + 1e-4
    assert (w.count_below(diagonal, off, points) == (values[:, None] < points).sum(axis=0)).all()


def test_equals_brute_force(spark):
    rng = random.Random(5)
    data = [(i, [rng.gauss(0, 1 + d) for d in range(20)]) for i in range(300)]
    data += [(i, data[i % 7][1]) for i in range(300, 500)] + [data[3], data[3], (None, data[4][1])]
    odd = [(600, None), (601, [None] * 20), (602, [math.nan] * 20), (603, [math.inf] * 20), (604, [1.0]), (605, [])]
    got = run(spark, data + odd)
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in data])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    y = fit - sums / n
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:16], vectors.T[::-1][:16]
    table = {}
    for (i, _), row in zip(data, x):
        deviation = int(((n * row.astype(object) - sums.astype(object)) ** 2).sum())
        table.setdefault(i, []).append((deviation, (row - sums / n) @ vectors.T / np.sqrt(values)))
    assert len(got) == 16 * len(data)
    signs = {}
    for r in got:
        deviation, z = table[r["vec_id"]][0]
        z = z[r["component"] - 1]
        signs.setdefault(r["component"], np.sign(z * r["whitened"]))
        assert r["n"] == n and r["deviation"] == deviation
        assert abs(signs[r["component"]] * z - r["whitened"]) < 1e-9
        assert abs(r["explained"] - values[r["component"] - 1] / np.trace(v)) < 1e-12
        assert r["identity_error"] < 1e-9


def test_little_data(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0, 2.0])] * 3) == []  # all equal: nothing to scale
    two = run(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0]), (2, [3.0, 2.0])])
    assert sorted((r["vec_id"], r["component"], abs(round(r["whitened"], 9)), r["n"], r["deviation"]) for r in two) == [
        (1, 1, 1.0, 2, 128**2),
        (2, 1, 1.0, 2, 128**2),
        (2, 1, 1.0, 2, 128**2),
    ]
    assert all(abs(r["explained"] - 1) < 1e-12 for r in two)


def test_large_components(spark):
    data = [(1, [1e9]), (2, [-1e9]), (3, [0.0])]
    with pytest.raises(Exception, match="64 bits"):
        run(spark, data)


def test_clashing_names(spark):
    df = frame(spark, [(1, [1.0], "a"), (2, [2.0], "b")], "x long, id array<double>, component string")
    rows = w.integer_rows(df, "x", "id")
    assert w.whiten(rows, w.fit(rows)).count() == 2
