"""Leading eigenpairs of a symmetric matrix by tridiagonalisation and bisection.

The matrix has one row and column per dimension of a vector, so its size does not grow
with the data.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps
_CLOSE = 1e-3  # eigenvalues nearer than this share of the norm belong to one cluster
_ROUNDS = 6


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Householder reflections that leave a diagonal and the entries beside it."""
    a = np.array(matrix, float)
    n = len(a)
    beside, reflectors = np.zeros(max(n - 1, 0)), []
    for k in range(n - 1):
        x = a[k + 1 :, k].copy()
        length = np.linalg.norm(x)
        if k == n - 2 or not np.any(x[1:]):
            beside[k] = x[0]
            reflectors.append(None)
            continue
        beside[k] = -np.copysign(length, x[0])
        x[0] -= beside[k]
        v = x / np.linalg.norm(x)
        p = a[k + 1 :, k + 1 :] @ v
        w = 2 * (p - (v @ p) * v)
        a[k + 1 :, k + 1 :] -= np.outer(v, w) + np.outer(w, v)
        reflectors.append(v)
    return a.diagonal().copy(), beside, reflectors


def count_below(diagonal: np.ndarray, beside: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie below each shift."""
    tiny = np.finfo(float).tiny / _EPS
    counts = np.zeros(len(shifts), int)
    q = np.ones(len(shifts))
    squares = np.concatenate([[0.0], beside**2])
    for d, square in zip(diagonal, squares, strict=True):
        q = d - shifts - square / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        counts += q < 0
    return counts


def leading_values(diagonal: np.ndarray, beside: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, each bisected down to rounding."""
    n = len(diagonal)
    reach = np.concatenate([[0.0], np.abs(beside)]) + np.concatenate([np.abs(beside), [0.0]])
    spread = max(np.max(np.abs(diagonal) + reach), np.finfo(float).tiny)
    low = np.full(count, np.min(diagonal - reach) - _EPS * spread)
    high = np.full(count, np.max(diagonal + reach) + _EPS * spread)
    wanted = n - 1 - np.arange(count)
    for _ in range(200):
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high) | (high - low <= _EPS * _EPS * spread)):
            break
        above = count_below(diagonal, beside, middle) <= wanted
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return (low + high) / 2


def _solve(diagonal: np.ndarray, beside: np.ndarray, right: np.ndarray, floor: float) -> np.ndarray:
    """Gaussian elimination with row exchanges; pivots are never below ``floor``."""
    n = len(diagonal)
    d, x = diagonal.tolist(), right.tolist()
    low, up, up2 = beside.tolist(), beside.tolist(), [0.0] * n
    for i in range(n - 1):
        if abs(d[i]) >= abs(low[i]):
            if abs(d[i]) < floor:
                d[i] = floor
            f = low[i] / d[i]
            d[i + 1] -= f * up[i]
            x[i + 1] -= f * x[i]
        else:
            f = d[i] / low[i]
            d[i], d[i + 1], up[i] = low[i], up[i] - f * d[i + 1], d[i + 1]
            if i + 1 < n - 1:
                up2[i], up[i + 1] = up[i + 1], -f * up[i + 1]
            x[i], x[i + 1] = x[i + 1], x[i] - f * x[i + 1]
    if abs(d[-1]) < floor:
        d[-1] = floor
    for i in range(n - 1, -1, -1):
        value = x[i]
        if i + 1 < n:
            value -= up[i] * x[i + 1]
        if i + 2 < n:
            value -= up2[i] * x[i + 2]
        x[i] = value / d[i]
    return np.array(x)


def vectors_of(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors as columns, by inverse iteration.

    Vectors of eigenvalues that lie close together are made orthogonal to those found
    before in their cluster after every step.
    """
    n = len(diagonal)
    norm = max(np.max(np.abs(diagonal)), np.max(np.abs(beside), initial=0.0), np.finfo(float).tiny)
    floor = _EPS * norm
    draws = np.random.default_rng(1)
    found, first = np.zeros((n, len(values))), 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > _CLOSE * norm:
            first = j
        # equal eigenvalues get shifts that differ by rounding
        shift = value - (j - first) * 2 * floor
        x = draws.uniform(-1, 1, n)
        for _ in range(_ROUNDS):
            x = _solve(diagonal - shift, beside, x / np.linalg.norm(x), floor)
            for _ in range(2):
                x /= np.linalg.norm(x)
                x -= found[:, first:j] @ (found[:, first:j].T @ x)
        found[:, j] = x / np.linalg.norm(x)
    return found


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns."""
    count = min(count, len(matrix))
    if not count:
        return np.zeros(0), np.zeros((len(matrix), 0))
    diagonal, beside, reflectors = tridiagonal(matrix)
    values = leading_values(diagonal, beside, count)
    found = vectors_of(diagonal, beside, values)
    for k in range(len(reflectors) - 1, -1, -1):
        v = reflectors[k]
        if v is not None:
            found[k + 1 :] -= 2 * np.outer(v, v @ found[k + 1 :])
    return values, found
