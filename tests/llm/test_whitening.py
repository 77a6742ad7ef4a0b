from fractions import Fraction

import numpy as np
import pytest

from tripmart.llm.whitening import covariance, refined_eigenvectors, whitened_vectors

DDL = "vec_id long, embedding array<float>"


def brute(rows, d):
    kept = [(k, tuple(int(np.floor(256 * float(c))) for c in v)) for k, v in rows
            if v is not None and len(v) == d and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({x for _, x in kept})
    n, total = len(fit), [sum(col) for col in zip(*fit, strict=True)]
    centred = np.array([[float(n * a - s) / n for a, s in zip(x, total, strict=True)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    deviation = {k: sum((n * a - s) ** 2 for a, s in zip(x, total, strict=True)) for k, x in kept}
    apart = np.array([[float(n * a - s) / n for a, s in zip(x, total, strict=True)] for _, x in kept])
    return kept, n, deviation, values[::-1], (apart @ vectors[:, ::-1]) / np.sqrt(values[::-1])


def vectors(seed, n, d):
    rng = np.random.default_rng(seed)
    data = (rng.normal(size=(n, d)) * np.linspace(0.1, 1.5, d)).astype(np.float32)
    rows = [(k, data[k].tolist()) for k in range(n)]
    rows += [(n, rows[0][1]), (n + 1, rows[0][1]), (n + 2, None), (n + 3, []), (n + 4, [1.0] * (d - 1)), (None, rows[1][1])]
    return rows + [(n + 5, [float("nan"), *rows[0][1][1:]]), (n + 6, [float("inf"), *rows[0][1][1:]]), (n + 7, [None, *rows[0][1][1:]])]


@pytest.mark.parametrize("d", [2, 6, 20])
def test_whitened_values_equal_brute_force(spark, d):
    rows = vectors(d, 120, d)
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], DDL + ", x string, n int").repartition(3)
    kept, n, deviation, values, want = brute(rows, d)
    got = whitened_vectors(df).collect()
    assert len(got) == len(kept) * min(4, d) and {r.vec_id for r in got} == {k for k, _ in kept}
    place = {k: i for i, (k, _) in enumerate(kept)}
    for c in range(1, min(4, d) + 1):
        own = [r for r in got if r.component == c]
        pairs = np.array([(r.whitened, want[place[r.vec_id], c - 1]) for r in own])
        assert np.abs(pairs[:, 0] - np.sign((pairs[:, 0] * pairs[:, 1]).sum()) * pairs[:, 1]).max() < 1e-8
        assert all(r.n == n and r.deviation == deviation[r.vec_id] and r.identity_error < 1e-12 for r in own)
        assert all(abs(r.explained - values[c - 1] / values.sum()) < 1e-12 for r in own)


def test_no_or_equal_vectors(spark):
    for rows in ([], [(1, None), (2, [])], [(1, [0.5, 0.5])] * 3):
        assert whitened_vectors(spark.createDataFrame(rows, DDL)).collect() == []


def test_a_dimension_without_variance_gives_no_component(spark):
    got = whitened_vectors(spark.createDataFrame([(k, [float(k), 2.0, 3.0]) for k in range(9)], DDL)).collect()
    assert {r.component for r in got} == {1} and got[0].explained == pytest.approx(1)


def test_very_large_entries_stay_exact(spark):
    rows = [(1, [1e9, 1.0]), (2, [-1e9, 2.0]), (3, [3e12, -7.0]), (4, [1e30, 0.0]), (5, [5.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, x array<double>").selectExpr("vec_id", "transform(x, c -> bigint(floor(least(c * 256, 1152921504606846976D)))) AS x")
    n, total, exact = covariance(df, 2)
    x = [r.x for r in df.collect()]
    mean = [Fraction(sum(v), 5) for v in zip(*x, strict=True)]
    assert (n, total) == (5, [sum(v) for v in zip(*x, strict=True)])
    assert exact == [[sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / 5 for j in range(2)] for i in range(2)]
    got = whitened_vectors(spark.createDataFrame(rows, DDL)).collect()
    assert {r.component for r in got} == {1} and len(got) == 5  # next to it the other is rounding


def reflected(values):
    """A symmetric matrix with these eigenvalues and its exact eigenvectors, made of fractions."""
    d = len(values)
    u = [Fraction(k + 1) for k in range(d)]
    norm = sum(v * v for v in u)
    q = [[Fraction(i == j) - 2 * u[i] * u[j] / norm for j in range(d)] for i in range(d)]
    a = [[sum(q[i][k] * values[k] * q[j][k] for k in range(d)) for j in range(d)] for i in range(d)]
    high = np.array([[float(v) for v in row] for row in a])
    low = np.array([[float(v - Fraction(x)) for v, x in zip(row, xs, strict=True)] for row, xs in zip(a, high.tolist(), strict=True)])
    return high.astype(np.longdouble) + low, np.array([[float(v) for v in row] for row in q])


@pytest.mark.parametrize("near", [Fraction(1, 10**3), Fraction(1, 10**6), Fraction(1, 10**9)])
def test_near_eigenvalues_are_parted(near):
    values = [Fraction(7), Fraction(5), 1 + 2 * near, 1 + near, Fraction(1), Fraction(1, 2), Fraction(1, 1000)]
    a, want = reflected(values)
    found, x = refined_eigenvectors(a)
    assert np.abs(found - np.array([float(v) for v in values])).max() < 1e-15
    signs = np.sign((x * want).sum(axis=0))
    error = np.abs((x * signs).astype(float) - want).max()
    assert error < max(1e-15, 1e-18 / float(near))
    plain = np.linalg.eigh(a.astype(np.float64))[1][:, ::-1]
    plain_error = np.abs(plain * np.sign((plain * want).sum(axis=0)) - want).max()
    assert error < plain_error


def test_equal_eigenvalues_give_an_orthogonal_basis():
    a, _ = reflected([Fraction(3)] * 3 + [Fraction(1)] * 4)
    values, x = refined_eigenvectors(a)
    assert np.abs(x.T @ x - np.eye(7)).max() < 1e-17 and np.abs(a @ x - x * values).max() < 1e-17 * 30
