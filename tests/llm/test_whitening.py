"""Contour integration against a dense solver, and whitening against plain numpy."""

import numpy as np
import pytest

pytest.importorskip("terrace.llm")

from terrace.llm.feast import above, intervals, largest_eigenpairs, tridiagonal  # noqa: E402
from terrace.llm.whitening import whiten  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, n long, x string, d int, w int"


@pytest.mark.parametrize("size, seed", [(1, 0), (2, 1), (5, 2), (64, 3), (120, 4)])
def test_largest_eigenpairs_equal_a_dense_solver(size, seed):
    a = np.random.default_rng(seed).standard_normal((3 * size, size)) * np.linspace(1, 5, size)
    matrix = a.T @ a / len(a)
    values, vectors = largest_eigenpairs(matrix, 4)
    want = np.linalg.eigvalsh(matrix)[::-1][:4]
    assert np.allclose(values, want, rtol=1e-12) and len(values) == min(4, size)
    assert np.allclose(matrix @ vectors, vectors * values, atol=1e-12 * want[0])
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-11)


def test_equal_and_close_eigenvalues_are_all_found():
    turn, _ = np.linalg.qr(np.random.default_rng(5).standard_normal((30, 30)))
    told = np.r_[[7.0] * 12, 3.0, 3.0 + 1e-9, np.linspace(0, 1, 16)]
    values, vectors = largest_eigenpairs((turn * told) @ turn.T, 14)
    assert np.allclose(values, np.sort(told)[::-1][:14], atol=1e-9) and np.allclose(vectors.T @ vectors, np.eye(14), atol=1e-9)
    assert len(largest_eigenpairs(np.zeros((3, 3)), 2)[0]) == 0
    assert np.allclose(largest_eigenpairs(np.diag([2.0, 0, 0]), 1)[0], [2.0])


def test_inertia_counts_and_intervals():
    matrix = np.diag(np.arange(20.0)) + 0.1
    told = tridiagonal(matrix)
    want = np.linalg.eigvalsh(matrix)
    for shift in (-1.0, 0.51, 7.3, 18.9, 40.0):
        assert above(*told, shift) == (want > shift).sum()
    for low, high, count in intervals(*told, 20, per_interval=3):
        assert count == ((want > low) & (want < high)).sum() and count <= 3


def rows_of(vectors):
    return [(i, v, 1, "x", 2, 3) for i, v in vectors]


def test_whitening_equals_numpy(spark):
    chance = np.random.default_rng(9)
    some = (chance.standard_normal((300, 6)) * [3, 2, 1, 0.5, 0.2, 0]) + [40, 0, -7, 0, 0, 0.25]
    vectors = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(some)]
    vectors += [vectors[3], vectors[3], (None, vectors[5][1]), (900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [float("nan")] * 6), (903, [float("inf")] + [0.0] * 5)]
    vectors += [(1000, [1.0, 2.0]), (1001, [3.0, 2.0]), (1002, []), (1003, [5.0])]
    found = whiten(spark.createDataFrame(rows_of(vectors), SCHEMA).repartition(5)).collect()
    held = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in vectors if v is not None and len(v) == 6 and None not in v and np.isfinite(v).all()]
    fit = np.unique(np.array([v for _, v in held]), axis=0)
    n, mean = len(fit), fit.mean(axis=0)
    covariance = (fit - mean).T @ (fit - mean) / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    got = {}
    for r in found:
        got.setdefault((r.vec_id, r.component), []).append(r)
    assert sum(len(v) for (i, _), v in got.items() if i is None or i < 900) == 4 * len(held)
    assert len(got[3, 1]) == 3 and all((None, c) in got for c in (1, 2, 3, 4))
    for k in range(4):
        side = None
        for i, v in held:
            want = float((v - mean) @ axes[:, k] / np.sqrt(values[k]))
            row = got[i, k + 1][0]
            side = side or (1 if want * row.whitened > 0 else -1)
            assert row.whitened == pytest.approx(side * want, abs=1e-9)
            assert row.n == n and row.deviation == sum(int(x) ** 2 for x in n * v - fit.sum(axis=0))
            assert row.explained == pytest.approx(values[k] / values.sum(), rel=1e-9) and row.identity_error < 1e-9
    # Vectors of two components are fitted apart; one vector or an empty one has no variance.
    assert {k for k in got if k[0] and k[0] >= 900} == {(1000, 1), (1001, 1)}
    assert [got[i, 1][0].n for i in (1000, 1001)] == [2, 2] and abs(got[1000, 1][0].whitened) == pytest.approx(1.0)


def test_no_vectors_and_large_entries(spark):
    assert whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame(rows_of([(1, None), (2, [1.0, 1.0]), (3, [1.0, 1.0])]), SCHEMA)).count() == 0
    large = whiten(spark.createDataFrame(rows_of([(1, [3e9, 0.0]), (2, [-3e9, 0.0])]), SCHEMA)).collect()
    assert [abs(r.whitened) for r in large] == [pytest.approx(1.0)] * 2 and [r.deviation for r in large] == [None, None]
