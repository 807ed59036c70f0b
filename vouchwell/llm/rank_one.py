"""Eigendecompositions of many matrices kept up to date under rank-one changes.

With A = U diag(d) U' and z = U'v, the eigenvalues of A + v v' are the roots of the secular
equation 1 + sum(z_j**2 / (d_j - x)) = 0, one above each d_j. Entries of z that are nearly
zero, and all but one of a set of nearly equal d_j (after a rotation), are deflated: their
eigenpairs stay. The eigenvectors come from a z recomputed from the roots, for which these are
exact, so they are orthogonal however close the roots lie.

All functions work on stacks: (m, n) values in rising order and (m, n, n) vectors in columns.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
ROUNDS = 60
#: A step below this share of a root's distance from its pole ends the search; steps shrink quadratically.
CLOSE = 1e-6


def update(values: np.ndarray, vectors: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The decompositions after adding ``change`` times its transpose, a row of ``change`` each."""
    z = np.matmul(change[:, None, :], vectors)[:, 0]
    norm = np.sqrt((z * z).sum(1))
    tolerance = 8 * EPS * (np.abs(values[:, -1]) + norm**2)
    z = np.where(np.abs(z) * norm[:, None] <= tolerance[:, None], 0.0, z)
    values, vectors, z = _deflated(values, vectors, z, tolerance)
    live = z != 0
    roots, gap = _roots(values, z, live)
    own = np.eye(values.shape[1], dtype=bool)
    if not live.all():
        gap[~(live[:, :, None] & live[:, None, :])] = np.inf
    again = _recomputed(values, z, gap, own)
    turn = np.divide(again[:, :, None], gap, out=gap)
    length = np.sqrt(np.einsum("mji,mji->mi", turn, turn))
    turn /= np.where(length > 0, length, 1.0)[:, None, :]
    if not live.all():
        turn = np.where(live[:, None, :], turn, own)
    return _sorted(np.where(live, roots, values), vectors @ turn)


def _sorted(values: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if (values[:, 1:] >= values[:, :-1]).all():
        return values, vectors
    by = np.argsort(values, axis=1, kind="stable")
    return np.take_along_axis(values, by, 1), np.take_along_axis(vectors, by[:, None, :], 2)


def _deflated(values, vectors, z, tolerance):
    """Rotate what z holds on nearly equal values onto one of them."""
    left, right = z[:, :-1], z[:, 1:]
    size = left * left + right * right
    near = np.abs((values[:, 1:] - values[:, :-1]) * left * right) <= tolerance[:, None] * size
    some = np.flatnonzero((near | (z == 0)[:, 1:] | (z == 0)[:, :-1]).any(1))
    if not len(some):
        return values, vectors, z
    values, vectors, z = values.copy(), vectors.copy(), z.copy()
    d, u, w, limit = values[some], vectors[some], z[some], tolerance[some]
    last = np.full(len(some), -1)
    for j in range(z.shape[1]):
        live = w[:, j] != 0
        m = np.flatnonzero(live & (last >= 0))
        i = last[m]
        size = np.hypot(w[m, i], w[m, j])
        c, s = w[m, j] / size, w[m, i] / size
        equal = np.abs((d[m, j] - d[m, i]) * c * s) <= limit[m]
        m, i, c, s, size = m[equal], i[equal], c[equal], s[equal], size[equal]
        if len(m):
            low, high = u[m, :, i], u[m, :, j]
            u[m, :, i], u[m, :, j] = c[:, None] * low - s[:, None] * high, s[:, None] * low + c[:, None] * high
            d[m, i], d[m, j] = d[m, i] * c * c + d[m, j] * s * s, d[m, i] * s * s + d[m, j] * c * c
            w[m, i], w[m, j] = 0.0, size
        last = np.where(live, j, last)
    by = np.argsort(d, axis=1, kind="stable")
    values[some], z[some] = np.take_along_axis(d, by, 1), np.take_along_axis(w, by, 1)
    vectors[some] = np.take_along_axis(u, by[:, None, :], 2)
    return values, vectors, z


def _roots(values, z, live):
    """(roots, gap[m, j, i] = value j less root i), each root found as a distance from the nearer pole."""
    m, n = values.shape
    square = z * z
    top = np.where(live, values, -np.inf).max(1, keepdims=True)
    beyond = np.concatenate([values, np.where(np.isfinite(top), top, 0.0) + square.sum(1, keepdims=True)], axis=1)
    index = np.where(live, np.arange(n), n)
    after = np.minimum.accumulate(index[:, ::-1], axis=1)[:, ::-1]
    after = np.concatenate([after[:, 1:], np.full((m, 1), n)], axis=1)
    final = after == n
    above = np.take_along_axis(beyond, after, 1)
    width = above - values
    idle = None if live.all() else ~(live[:, :, None] & live[:, None, :])
    weight = square[:, None, :]

    def inverse(gap):
        if idle is not None:
            gap[idle] = 1.0
        return np.divide(1.0, gap, out=gap)

    def weighted(terms):
        return np.matmul(weight, terms)[:, 0]

    middle = 1.0 + weighted(inverse(values[:, :, None] - (values + width / 2)[:, None, :]))
    right = (middle < 0) & ~final
    pole = np.where(right, above, values)
    low = np.where(right, -width / 2, np.where(final & (middle < 0), width / 2, 0.0))
    high = np.where(right, 0.0, np.where(final & (middle < 0), width, width / 2))
    shift = (low + high) / 2
    below = np.tri(n, dtype=float).T  # [j, i]: pole j is root i's own or lies below it
    here, there = values - pole, above - pole
    shift, settled = np.where(live, shift, 0.0), ~live
    base = values[:, :, None] - pole[:, None, :]
    room = np.empty_like(base)
    for _ in range(ROUNDS):
        term = inverse(np.subtract(base, shift[:, None, :], out=room))
        f = 1.0 + weighted(term)
        np.multiply(term, term, out=term)
        slope = weighted(term)
        term *= below
        lower = weighted(term)
        low, high = np.where(f < 0, shift, low), np.where(f < 0, high, shift)
        a, b = here - shift, there - shift
        c = f - a * lower - b * (slope - lower)
        with np.errstate(all="ignore"):
            p, q = (a + b) * f - a * b * slope, a * b * f
            root = np.sqrt(np.maximum(p * p - 4 * q * c, 0.0))
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
            step = np.where(final, a + lower * a * a / (f - a * lower), step)
            new = shift + step
        small = np.abs(step) <= CLOSE * np.abs(shift)
        inside = np.isfinite(new) & (new > low) & (new < high)
        shift = np.where(settled, shift, np.where(inside | small, new, (low + high) / 2))
        settled |= small
        if settled.all():
            break
    return pole + shift, base - shift[:, None, :]


def _recomputed(values, z, gap, own):
    """The z for which the roots are exact: products of distances to roots over those to values."""
    apart = values[:, :, None] - values[:, None, :]
    apart[:, own] = -1.0
    with np.errstate(all="ignore"):
        ratio = np.divide(gap, apart, out=apart)
        ratio[np.isinf(gap)] = 1.0
        square = np.abs(np.prod(ratio, axis=2))
        again = np.copysign(np.sqrt(square), z)
    return np.where((z != 0) & np.isfinite(again) & (again != 0), again, z)
