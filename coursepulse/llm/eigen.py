"""Eigenvectors of a symmetric matrix by mixed-precision refinement.

A float32 decomposition gives the first eigenvectors. Each step of Ogita and Aishima's iteration (2018)
corrects all of them by matrix products in extended precision: with ``R = I - X'X`` and ``S = X'AX``,

    lambda_i = S_ii / (1 - R_ii)
    E_ij     = (S_ij + lambda_j R_ij) / (lambda_j - lambda_i)    where the eigenvalues are apart
    E_ij     = R_ij / 2                                          where they are not
    X        = X + X E

which converges quadratically. Eigenvalues closer than the current error cannot be told apart by that quotient; they form
a cluster, whose small problem ``X_J' (A - mu I) X_J`` (``mu``: the cluster's mean) is solved on its own and rotates the cluster's
vectors (the same authors' 2019 treatment of clustered eigenvalues): with the shift, gaps that were lost beside
the norm of ``A`` stand out. The steps after it refine the rotated vectors too. Vectors of one exactly repeated
eigenvalue are an orthonormal basis of its space.
"""

from __future__ import annotations

import numpy as np

WIDE = np.longdouble
MAX_STEPS = 20


def _groups(values: np.ndarray, apart: float) -> list[np.ndarray]:
    """Indices of eigenvalues that a chain of gaps of at most ``apart`` links, two at least."""
    order = np.argsort(values)
    cut = np.flatnonzero(np.diff(values[order]) > apart) + 1
    return [g for g in np.split(order, cut) if len(g) > 1]


def _solve(a: np.ndarray, kind) -> np.ndarray:
    """Eigenvectors of a small matrix in the precision ``kind``, scaled to norm 1 first."""
    top = np.abs(a).max()
    return np.linalg.eigh((a / top).astype(kind))[1].astype(WIDE) if top > 0 else np.eye(len(a), dtype=WIDE)


def eigenvectors(a: np.ndarray, max_steps: int = MAX_STEPS) -> tuple[np.ndarray, np.ndarray, int]:
    """``(eigenvalues, unit eigenvectors as columns, steps)`` by falling eigenvalue, in extended precision.

    Each vector's component of the largest magnitude (the first on ties) is positive.
    """
    a = np.asarray(a, WIDE)
    d = len(a)
    norm = np.sqrt((a * a).sum())
    one = np.eye(d, dtype=WIDE)
    if not norm > 0:
        return np.zeros(d, WIDE), one, 0
    a = a / norm
    eps = np.finfo(WIDE).eps
    x, steps, last = _solve(a, np.float32), 0, np.inf
    while steps < max_steps:
        r = one - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2  # so that E + E' = R up to rounding: corrected vectors stay orthogonal
        lam = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        apart = 2 * (np.sqrt((off * off).sum()) + np.sqrt((r * r).sum()))
        gap = lam[None, :] - lam[:, None]
        far = np.abs(gap) > apart
        e = np.where(far, (s + lam[None, :] * r) / np.where(far, gap, 1), r / 2)
        np.fill_diagonal(e, np.diag(r) / 2)
        x = x + x @ e
        steps += 1
        change = np.abs(e).max()
        for j in _groups(lam, apart):
            xj = x[:, j]
            shifted = xj.T @ (a @ xj - lam[j].mean() * xj)
            if np.abs(shifted).max() > 4 * d * eps:  # below, the cluster is one eigenvalue to the last digit
                turn = _solve((shifted + shifted.T) / 2, np.float64)
                x[:, j] = xj @ turn
                change = max(change, np.abs(turn - np.diag(np.diag(turn))).max() if steps < 3 else change)
        if change <= 4 * eps or (steps > 4 and change >= last and change < 1e-15):
            break
        last = change
    x = x + x @ ((one - x.T @ x) / 2)  # the sub-solves' rotations are float64: orthogonal to the last digit again
    lam = np.diag(x.T @ (a @ x)) / np.diag(x.T @ x)
    order = np.argsort(-lam, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    top = np.abs(x).argmax(axis=0)
    return lam[order] * norm, x * np.where(x[top, np.arange(d)] < 0, -1, 1), steps
