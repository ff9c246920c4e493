"""Cubic smoothing splines of a curve with as few knots as a bound on the sum of squares takes (Dierckx's ``curfit``)."""

from __future__ import annotations

import numpy as np

#: Degree, and the share of the bound by which the sum of squares may miss it.
DEGREE, TOLERANCE, MOST_STEPS = 3, 1e-3, 20


def basis(knots: np.ndarray, x: np.ndarray) -> np.ndarray:
    """B-splines (columns) at each of ``x``; the end counts to the last stretch."""
    last = len(knots) - DEGREE - 2
    at = np.clip(np.searchsorted(knots, x, "right") - 1, DEGREE, last)
    some = np.zeros((len(x), DEGREE + 1))
    some[:, 0] = 1.0
    for d in range(1, DEGREE + 1):
        saved = np.zeros(len(x))
        for j in range(d):
            right, left = knots[at + j + 1], knots[at + 1 - d + j]
            part = some[:, j] / (right - left)
            some[:, j] = saved + (right - x) * part
            saved = (x - left) * part
        some[:, d] = saved
    out = np.zeros((len(x), last + 1))
    out[np.arange(len(x))[:, None], at[:, None] - DEGREE + np.arange(DEGREE + 1)] = some
    return out


def evaluate(spline: tuple[np.ndarray, np.ndarray], x: np.ndarray, piece: int = 4096) -> np.ndarray:
    knots, c = spline
    return np.concatenate([basis(knots, x[k : k + piece]) @ c for k in range(0, len(x), piece)]) if len(x) else np.zeros(0)


def _jumps(knots: np.ndarray) -> np.ndarray:
    """Per inner knot the jumps of the highest derivative of the B-splines around it, scaled to even stretches."""
    k, n = DEGREE, len(knots) - DEGREE - 1
    scale = (n - k) / (knots[n] - knots[k])
    out = np.zeros((max(0, n - k - 1), n))
    for row, at in enumerate(range(k + 1, n)):
        h = knots[at] - np.append(knots[at - k - 1 : at], knots[at + 1 : at + k + 2])
        for j in range(k + 2):
            out[row, row + j] = (knots[row + j + k + 1] - knots[row + j]) / (h[j : j + k + 1].prod() * scale**k)
    return out


def _more_knots(inner: list[float], x: np.ndarray, square: np.ndarray, some: int) -> list[float]:
    """One knot after the other goes to the middle point of the stretch with the largest sum of squares."""
    edges = [0, *np.searchsorted(x, inner).tolist(), len(x) - 1]  # knots are points
    sums, inside = [], []
    for k, (a, b) in enumerate(zip(edges, edges[1:])):
        left, right = square[a] * (1.0 if not k else 0.5), square[b] * (1.0 if k == len(edges) - 2 else 0.5)
        sums.append(square[a + 1 : b].sum() + left + right)
        inside.append(b - a - 1)
    for _ in range(some):
        free = [k for k in range(len(sums)) if inside[k]]
        if not free:
            break
        k = max(free, key=lambda j: sums[j])
        half = inside[k] // 2 + 1
        edges.insert(k + 1, edges[k] + half)
        n, total = inside[k], sums[k]
        inside[k : k + 1] = [half - 1, n - half]
        sums[k : k + 1] = [total * (half - 1) / n, total * (n - half) / n]
    return x[edges[1:-1]].tolist()


def smoothing_spline(x: np.ndarray, y: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Knots and coefficients of the smoothest spline whose sum of squared differences is ``bound``; a cubic if one has no more.

    ``x`` is ascending. Knots are added until least squares are within the bound; then jumps at the knots are weighed against it.
    """
    m, near = len(x), TOLERANCE * bound
    inner: list[float] = []
    more, first, before = 0, 0.0, 0.0
    while True:
        knots = np.concatenate([[x[0]] * (DEGREE + 1), inner, [x[-1]] * (DEGREE + 1)])
        a = basis(knots, x)
        q, r = np.linalg.qr(a)
        c = np.linalg.lstsq(r, q.T @ y, rcond=None)[0]
        square = (y - a @ c) ** 2
        over = square.sum() - bound
        if not inner:
            first = over
        if abs(over) < near or (not inner and over < 0):
            return knots, c
        if over < 0 or len(knots) >= m + DEGREE + 1:
            break
        if not inner:
            more = 1
        else:
            gain = before - square.sum()
            wanted = int(more * over / gain) if gain > near else 2 * more
            more = min(2 * more, max(wanted, more // 2, 1))
        before = square.sum()
        inner = _more_knots(inner, x, square, min(more, m + DEGREE + 1 - len(knots)))
    if over >= 0:
        return knots, c
    jumps, z = _jumps(knots), q.T @ y
    p1, f1, p3, f3 = 0.0, first, -1.0, over
    p, low, high = a.shape[1] / np.abs(np.diag(r)).sum(), False, False
    for _ in range(MOST_STEPS):
        c = np.linalg.lstsq(np.vstack([r, jumps / p]), np.append(z, np.zeros(len(jumps))), rcond=None)[0]
        p2, f2 = p, ((y - a @ c) ** 2).sum() - bound
        if abs(f2) < near:
            break
        if not high:
            if f2 - f3 <= near:  # too near the least squares
                p3, f3, p = p2, f2, p * 0.04
                p = p1 * 0.9 + p2 * 0.1 if p <= p1 else p
                continue
            high = f2 < 0
        if not low:
            if f1 - f2 <= near:  # too near the cubic
                p1, f1, p = p2, f2, p / 0.04
                p = p2 * 0.1 + p3 * 0.9 if p3 >= 0 and p >= p3 else p
                continue
            low = f2 > 0
        if f2 >= f1 or f2 <= f3:
            break
        if p3 > 0:
            h1, h2, h3 = f1 * (f2 - f3), f2 * (f3 - f1), f3 * (f1 - f2)
            p = -(p1 * p2 * h3 + p2 * p3 * h1 + p3 * p1 * h2) / (p1 * h1 + p2 * h2 + p3 * h3)
        else:
            p = (p1 * (f1 - f3) * f2 - p2 * (f2 - f3) * f1) / ((f1 - f2) * f3)
        if f2 >= 0:
            p1, f1 = p2, f2
        else:
            p3, f3 = p2, f2
    return knots, c
