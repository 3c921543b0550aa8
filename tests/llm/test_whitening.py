"""Whitened vectors against eigenvectors from numpy."""

from __future__ import annotations

import math

import numpy as np
import pytest

from rollbook.llm import whitening

ROWS = "vec_id long, embedding array<float>, n int, whitened string"


def matrix(vectors, width):
    return np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in (*v, *[0.0] * (width - len(v)))] for v in vectors])


def run(spark, rows, **more):
    return whitening.whiten(spark.createDataFrame(rows, ROWS).repartition(4), **more).collect()


def check(spark, rows, vectors, width, wanted=8):
    x = matrix(vectors, width)
    n, sums = len(x), x.sum(axis=0)
    v = np.cov(x.T, bias=True).reshape(width, width)
    values, directions = np.linalg.eigh(v)
    values, directions = values[::-1], directions[:, ::-1]
    got = run(spark, rows, wanted=wanted)
    k = min(wanted, width)
    assert len(got) == n * k
    by = {}
    for r in got:
        assert r["n"] == n
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(v), rel=1e-9)
        assert abs(r["identity_error"]) < 1e-9
        by.setdefault(r["component"], {})[r["vec_id"]] = r["whitened"]
    deviations = {r["vec_id"]: int(r["deviation"]) for r in got}
    for i, (vec_id, *_) in enumerate(rows_of(rows)):
        assert deviations[vec_id] == sum(int(n * a - s) ** 2 for a, s in zip(x[i].tolist(), sums.tolist(), strict=True))
    for c in range(1, k + 1):
        want = (x - sums / n) @ directions[:, c - 1] / math.sqrt(values[c - 1])
        own = np.array([by[c][vec_id] for vec_id, *_ in rows_of(rows)])
        assert min(np.abs(own - want).max(), np.abs(own + want).max()) < 1e-8


def rows_of(rows):
    return [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]


def test_against_numpy(spark):
    draw = np.random.default_rng(5)
    mixed = draw.standard_normal((400, 12)) @ draw.standard_normal((12, 12)) / 6
    rows = [(k, v.tolist(), 0, "x") for k, v in enumerate(mixed)]
    rows += [(900, None, 0, None), (901, [0.1, None], 0, None), (902, [float("nan")] * 12, 0, None), (903, [float("inf"), 1.0], 0, None)]
    rows += [(1000 + k, [0.5] * 12, 0, None) for k in range(200)]  # a vector that a third of all share
    kept = rows_of(rows)
    check(spark, rows, [r[1] for r in kept], 12)


def test_shorter_vectors_and_few_dimensions(spark):
    rows = [(k, [math.sin(k), math.cos(3 * k) / 2, k / 50][: 1 + k % 3], 0, "") for k in range(40)]
    check(spark, rows, [r[1] for r in rows], 3)


def test_nothing_and_constants(spark):
    assert run(spark, [(1, None, 0, "")]) == []
    assert run(spark, [(1, [], 0, "")]) == []
    found = run(spark, [(k, [0.25, k / 8], 0, "") for k in range(3)])
    assert [r["whitened"] for r in found if r["component"] == 2] == [0.0] * 3
    assert {r["identity_error"] for r in found} == {1.0}
    assert [(r["whitened"], r["explained"], r["deviation"]) for r in run(spark, [(None, [0.5], 0, "")])] == [(0.0, 0.0, 0)]


def test_exact_beyond_64_bits(spark):
    x = spark.createDataFrame([(1, [0, 5]), (2, [3 * 10**9, 7])], "id long, x array<long>")
    model = whitening.Whitening(10**6, np.array([10**15, 10**6]), np.ones(1), np.ones((2, 1)), 1.0, 0)
    got = {r["id"]: int(r["deviation"]) for r in whitening.whitened(x, model).collect()}
    assert got == {1: 10**30 + (4 * 10**6) ** 2, 2: (3 * 10**15 - 10**15) ** 2 + (6 * 10**6) ** 2}


@pytest.mark.parametrize("values", [[1, 2, 3], [5, 5, 5, 1, 1, 0], [1e-12, 1, 1e6], list(range(40)), [7], [0, 0]])
def test_components(values):
    draw = np.random.default_rng(3)
    q, _ = np.linalg.qr(draw.standard_normal((len(values), len(values))))
    v = q @ np.diag(np.array(values, dtype=float)) @ q.T
    found, u = whitening.components(v, 8)
    k, size = min(8, len(values)), max(np.linalg.norm(v), 1e-300)
    assert np.abs(found - sorted(values, reverse=True)[:k]).max() <= 1e-13 * size
    assert np.abs(u.T @ u - np.eye(k)).max() < 1e-13
    assert np.abs((v + v.T) / 2 @ u - u * found).max() <= 1e-13 * size


def test_polar_factor_is_the_sign():
    draw = np.random.default_rng(4)
    a = draw.standard_normal((30, 30))
    a = a + a.T
    values, q = np.linalg.eigh(a)
    assert np.abs(whitening.polar_factor(a) - q @ np.diag(np.sign(values)) @ q.T).max() < 1e-13
