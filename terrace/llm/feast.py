"""The largest eigenvalues of a symmetric matrix by contour integration.

Inertia counts (how many eigenvalues lie above a shift, from the signs of a Sturm sequence)
cut the upper end of the spectrum into intervals of few eigenvalues. For each interval, the
integral of the resolvent around it projects a block of vectors onto its eigenvectors;
Gauss-Legendre nodes on the upper half circle each take one solve with a complex-shifted
matrix. Rayleigh-Ritz on the projected block gives eigenpairs, which are projected again until
their residuals are at rounding level. An interval is done only if it holds as many
eigenpairs as the inertia counts say.
"""

from __future__ import annotations

import numpy as np

NODES = 8
PER_INTERVAL = 8
MOST_ROUNDS = 60


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a similar tridiagonal matrix, by Householder reflections."""
    a = np.array(matrix, dtype=float)
    size = len(a)
    for k in range(size - 2):
        x = a[k + 1 :, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        length = np.linalg.norm(x)
        if length == 0:
            continue
        x /= length
        part = a[k + 1 :, k + 1 :]
        p = part @ x
        w = p - (x @ p) * x
        part -= 2 * (np.outer(x, w) + np.outer(w, x))
        a[k + 1 :, k] -= 2 * x * (x @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
    return np.diag(a).copy(), np.diag(a, 1).copy()


def above(diagonal: np.ndarray, beside: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the tridiagonal matrix are larger than the shift."""
    tiny = np.finfo(float).tiny * 1e10 + np.finfo(float).eps * float(np.abs(beside).max(initial=0)) ** 2 * 1e-16
    count, pivot = 0, 1.0
    for i, d in enumerate(diagonal.tolist()):
        pivot = d - shift - (beside[i - 1] ** 2 / pivot if i else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot > 0
    return count


def intervals(diagonal: np.ndarray, beside: np.ndarray, wanted: int, per_interval: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside), from the top, until ``wanted`` are covered. No eigenvalue is near a cut."""
    reach = np.abs(np.r_[0.0, beside]) + np.abs(np.r_[beside, 0.0])
    low, high = float((diagonal - reach).min()), float((diagonal + reach).max())
    size = max(abs(low), abs(high), np.finfo(float).tiny)
    low, high = low - 1e-3 * size, high + 1e-3 * size
    count = lambda at: above(diagonal, beside, at)
    out, todo, covered = [], [(low, high, count(low), count(high))], 0
    while todo and covered < wanted:
        low, high, more, fewer = todo.pop()
        inside = more - fewer
        if inside == 0:
            continue
        cut = None
        if inside > per_interval and high - low > 1e-8 * size:
            free = 1e-6 * (high - low)
            for share in (0.5, 0.46, 0.54, 0.41, 0.59, 0.37, 0.63, 0.33, 0.67):
                at = low + share * (high - low)
                if count(at - free) == count(at + free):
                    cut = at
                    break
        if cut is None:
            out.append((low, high, inside))
            covered += inside
        else:
            middle = count(cut)
            todo += [(low, cut, more, middle), (cut, high, middle, fewer)]
    return out


def eigenpairs_in(matrix: np.ndarray, low: float, high: float, count: int, nodes: int = NODES, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """All ``count`` eigenvalues between low and high, and their unit eigenvectors as columns."""
    size, norm = len(matrix), np.linalg.norm(matrix)
    block = np.random.default_rng(seed).standard_normal((size, min(size, max(2 * count, count + 4))))
    place, weight = np.polynomial.legendre.leggauss(nodes)
    angle = np.pi / 2 * (1 - place)
    circle = (high - low) / 2 * np.exp(1j * angle)
    shifts = (low + high) / 2 + circle
    best, still = np.inf, 0
    for _ in range(MOST_ROUNDS):
        projected = np.zeros_like(block)
        for z, c, w in zip(shifts, circle, weight, strict=True):
            projected += w / 2 * (c * np.linalg.solve(z * np.eye(size) - matrix, block.astype(complex))).real
        basis, _ = np.linalg.qr(projected)
        small = basis.T @ matrix @ basis
        values, turn = np.linalg.eigh((small + small.T) / 2)
        vectors = basis @ turn
        inside = (values > low) & (values < high)
        residual = np.linalg.norm(matrix @ vectors - vectors * values, axis=0)
        if inside.sum() == count:
            worst = residual[inside].max(initial=0)
            still = 0 if worst < 0.5 * best else still + 1
            best = min(best, worst)
            if worst <= 1e-15 * norm * size**0.5 or (still >= 2 and worst <= 1e-12 * norm * size**0.5):
                return values[inside], vectors[:, inside]
        block = vectors
    raise ArithmeticError(f"{count} eigenvalues lie between {low} and {high}, but their eigenvectors were not found")


def largest_eigenpairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, with unit eigenvectors as columns; each one's largest entry is positive."""
    matrix = np.asarray(matrix, dtype=float)
    if not len(matrix) or not matrix.any():
        return np.zeros(0), np.zeros((len(matrix), 0))
    found = [eigenpairs_in(matrix, *interval) for interval in intervals(*tridiagonal(matrix), min(wanted, len(matrix)))]
    values, vectors = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found], axis=1)
    order = np.argsort(-values, kind="stable")[:wanted]
    values, vectors = values[order], vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return values, vectors * signs / np.linalg.norm(vectors, axis=0)
