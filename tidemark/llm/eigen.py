"""Leading eigenpairs of a symmetric matrix of a table's statistics: small, whatever the table's size.

Householder reflections make the matrix tridiagonal, Sturm counts bisect the leading eigenvalues, inverse iteration
finds their vectors, and vectors of close eigenvalues are made orthogonal to each other in every step.
"""

from __future__ import annotations

import numpy as np

CLOSE = 1e-3  # part of the matrix norm within which eigenvalues form a cluster
STEPS = 6  # of inverse iteration; from an eigenvalue known to the last bits, two or three suffice
EPS = np.finfo(float).eps


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the reflections (unit vectors, or zero where none was needed)."""
    a = np.array(matrix, float)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        column = a[k + 1 :, k]
        v = np.zeros(n)
        below = np.abs(column[1:]).max()
        if below > 0.0:
            scaled = column / max(below, abs(column[0]))
            v[k + 1 :] = scaled
            v[k + 1] += np.copysign(np.linalg.norm(scaled), scaled[0])
            v /= np.linalg.norm(v)
            p = a @ v
            q = p - v * (v @ p)
            a -= 2.0 * (np.outer(v, q) + np.outer(q, v))
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def count_below(diagonal: list[float], squares: list[float], x: float, tiny: float) -> int:
    """Sturm count: the eigenvalues below ``x`` are the negative pivots of the matrix minus x."""
    count, pivot = 0, 1.0
    for at, d in enumerate(diagonal):
        pivot = d - x - (squares[at - 1] / pivot if at else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot < 0.0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> list[float]:
    """The k greatest eigenvalues, falling, each bisected to the last bits."""
    n = len(diagonal)
    around = np.zeros(n)
    around[:-1] += np.abs(off)
    around[1:] += np.abs(off)
    low, high = float((diagonal - around).min()), float((diagonal + around).max())
    norm = max(abs(low), abs(high))
    tiny = max(EPS * EPS * norm, np.finfo(float).tiny)
    low, high = low - EPS * norm * n - tiny, high + EPS * norm * n + tiny
    d, squares = diagonal.tolist(), (off * off).tolist()
    values = []
    for place in range(1, k + 1):
        a, b = low, min(high, values[-1] if values else high)
        # The value with n - place others below it; equal values come once for each of their number.
        if count_below(d, squares, b, tiny) <= n - place:
            values.append(b)
            continue
        while b - a > 2 * EPS * max(abs(a), abs(b)) + tiny:
            middle = a + (b - a) / 2
            if middle in (a, b):
                break
            if count_below(d, squares, middle, tiny) <= n - place:
                a = middle
            else:
                b = middle
        values.append(a + (b - a) / 2)
    return values


def solver(diagonal: np.ndarray, off: np.ndarray, shift: float, tiny: float):
    """Solves (T - shift) x = y again and again: elimination with row exchanges, done once."""
    n = len(diagonal)
    first, second, third = diagonal - shift, np.append(off, 0.0), np.zeros(n)
    steps = []
    for i in range(n - 1):
        lower = off[i]
        if abs(first[i]) >= abs(lower):
            swap = False
            if abs(first[i]) < tiny:
                first[i] = tiny
            factor = lower / first[i]
            first[i + 1] -= factor * second[i]
        else:
            swap = True
            factor = first[i] / lower
            top = second[i]
            first[i], second[i], third[i] = lower, first[i + 1], second[i + 1]
            first[i + 1] = top - factor * second[i]
            second[i + 1] = -factor * third[i]
        steps.append((swap, factor))
    if abs(first[-1]) < tiny:
        first[-1] = tiny

    def solve(y: np.ndarray) -> np.ndarray:
        x = y.copy()
        for i, (swap, factor) in enumerate(steps):
            if swap:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= factor * x[i]
        for i in range(n - 1, -1, -1):
            if i + 1 < n:
                x[i] -= second[i] * x[i + 1]
            if i + 2 < n:
                x[i] -= third[i] * x[i + 2]
            x[i] /= first[i]
        return x

    return solve


def leading_pairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k greatest eigenvalues, falling, and their unit vectors as columns."""
    n = len(matrix)
    k = min(k, n)
    scale = np.abs(matrix).max(initial=0.0)
    if not scale:
        return np.zeros(k), np.eye(n, k)
    # With entries up to one, nothing over- or underflows on the way.
    diagonal, off, reflections = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, k)
    norm = np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0)
    tiny = EPS * norm
    draw = np.random.default_rng(12)
    vectors = np.zeros((n, k))
    begin = 0
    for place, value in enumerate(values):
        if place and values[place - 1] - value > CLOSE * norm:
            begin = place
        cluster = vectors[:, begin:place]
        # Equal values are set apart by a few last bits, else they would all find the same vector.
        solve = solver(diagonal, off, value - (place - begin) * 2 * tiny, tiny)
        x = draw.uniform(-1.0, 1.0, n)
        for _ in range(STEPS):
            for _ in range(2):  # twice is enough
                x = x - cluster @ (cluster.T @ x)
            x = solve(x / np.linalg.norm(x))
            x /= np.abs(x).max()
        for _ in range(2):
            x = x - cluster @ (cluster.T @ x)
        vectors[:, place] = x / np.linalg.norm(x)
    for v in reversed(reflections):
        vectors -= 2.0 * np.outer(v, v @ vectors)
    return np.array(values) * scale, vectors / np.linalg.norm(vectors, axis=0)
