"""Eigendecompositions of symmetric matrices that grow by rank-one terms.

``diag(d) + rho z z'`` has one eigenvalue between each two neighbours of ``d`` (and one above the last),
where the secular function ``1 + rho sum z_i^2 / (d_i - x)`` is zero.  All roots are sought at
once: each is kept as a distance from its nearer pole, steps come from a two-pole rational
fit ("middle way") and are held inside a shrinking bracket.  Entries of ``z`` that are negligible, and
pairs of equal ``d``, are deflated first.  The vectors use the ``z`` for which the computed roots are
exact, so they are orthogonal to working precision however close the roots are.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
MOST_STEPS = 120


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> np.ndarray:
    """``d[i] - root[j]`` for all roots, each difference to full relative precision; ``d`` ascends strictly,
    no ``z`` is zero, ``z`` has length 1 and ``rho`` is positive."""
    n = len(d)
    if n == 1:
        return np.array([[-rho]])
    zz = rho * z * z
    ends = np.append(d[1:], d[-1] + rho)
    half = (ends - d) / 2
    low_side = d[:, None] - (d + half)[None, :]
    left = 1 + (zz[:, None] / low_side).sum(axis=0) >= 0
    left[-1] = True
    origin = np.where(left, np.arange(n), np.minimum(np.arange(n) + 1, n - 1))
    pole = d[:, None] - d[origin][None, :]
    lo = np.where(left, 0.0, -half)
    hi = np.where(left, half, 0.0)
    hi[-1] = ends[-1] - d[-1]
    x = (lo + hi) / 2
    below = np.arange(n)[:, None] <= np.arange(n)[None, :]
    next_pole = np.append(d[1:], ends[-1]) - d[origin]
    own_pole = d - d[origin]
    open_ = np.arange(n)
    for _ in range(MOST_STEPS):
        gap = pole[:, open_] - x[open_]
        term = zz[:, None] / gap
        f = 1 + term.sum(axis=0)
        bound = EPS * n * (1 + np.abs(term).sum(axis=0))
        at = x[open_]
        lo[open_] = np.where(f < 0, at, lo[open_])
        hi[open_] = np.where(f < 0, hi[open_], at)
        narrow = hi[open_] - lo[open_] <= 2 * EPS * np.maximum(np.abs(lo[open_]), np.abs(hi[open_]))
        go = (np.abs(f) > bound) & ~narrow
        if not go.any():
            break
        open_, gap, term, f, at = open_[go], gap[:, go], term[:, go], f[go], at[go]
        slope = term / gap
        psi = np.where(below[:, open_], slope, 0).sum(axis=0)
        phi = slope.sum(axis=0) - psi
        a_gap, b_gap = own_pole[open_] - at, next_pole[open_] - at
        with np.errstate(all="ignore"):
            a = (a_gap + b_gap) * f - a_gap * b_gap * (psi + phi)
            b = a_gap * b_gap * f
            c = f - a_gap * psi - b_gap * phi
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = at + step
        inside = np.isfinite(new) & (new > lo[open_]) & (new < hi[open_])
        x[open_] = np.where(inside, new, (lo[open_] + hi[open_]) / 2)
    # a root that rounding puts on its pole stays a hair beside it
    tiny = np.finfo(float).tiny
    x = np.where(x == 0, np.where(left, tiny, -tiny), x)
    return pole - x


def rank_one(d: np.ndarray, q: np.ndarray, v: np.ndarray, rho: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors (columns) of ``q diag(d) q' + rho v v'``, ``rho`` >= 0."""
    z = q.T @ v
    size = float(np.linalg.norm(z))
    if not size or not rho:
        return d, q
    z, rho = z / size, rho * size * size
    tol = 8 * EPS * max(float(np.abs(d).max()), rho)
    z = np.where(rho * np.abs(z) <= tol, 0.0, z)
    keep = np.flatnonzero(z)
    if len(keep) > 1:
        a, b = keep[:-1], keep[1:]
        near = (d[b] - d[a]) * np.abs(z[a] * z[b]) <= tol * (z[a] ** 2 + z[b] ** 2)
        if near.any():
            d, q, z = _rotate_equal(d.copy(), q.copy(), z.copy(), keep, tol)
            keep = np.flatnonzero(z)
    if not len(keep):
        return d, q
    order = keep[np.argsort(d[keep], kind="stable")]
    dk, zk = d[order], z[order]
    gap = secular_roots(dk, zk / np.linalg.norm(zk), rho * float(zk @ zk))
    # the z of which the computed roots are the exact ones
    m = len(dk)
    spread = dk[None, :] - dk[:, None]  # d_j - d_i
    other = np.empty((m, m))
    below = np.tri(m, m, -1, dtype=bool)
    other[:, :-1] = np.where(below[:, :-1], spread[:, :-1], spread[:, 1:])
    other[:, -1] = 1.0
    exact = np.sqrt(np.abs(np.prod(-gap / other, axis=1))) * np.sign(zk)
    u = exact[:, None] / gap
    u /= np.linalg.norm(u, axis=0)
    near_pole = np.argmin(np.abs(gap), axis=0)
    roots = dk[near_pole] - gap[near_pole, np.arange(m)]
    values, vectors = d.copy(), q.copy()
    values[order], vectors[:, order] = roots, q[:, order] @ u
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def _rotate_equal(d: np.ndarray, q: np.ndarray, z: np.ndarray, keep: np.ndarray, tol: float) -> tuple[np.ndarray, ...]:
    """Turn the vectors of (nearly) equal values so that only the last of them has a part in ``z``."""
    last = keep[0]
    for i in keep[1:]:
        length = np.hypot(z[last], z[i])
        c, s = z[i] / length, -z[last] / length
        if (d[i] - d[last]) * abs(c * s) <= tol:
            z[i], z[last] = length, 0.0
            q[:, last], q[:, i] = c * q[:, last] + s * q[:, i], c * q[:, i] - s * q[:, last]
            d[last], d[i] = d[last] * c * c + d[i] * s * s, d[last] * s * s + d[i] * c * c
        last = i
    return d, q, z
