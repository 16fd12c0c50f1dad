"""Eigenvectors of a symmetric matrix by spectral divide and conquer with polar decompositions (QDWH).

The polar factor of the matrix less a shift is its sign: +1 on the subspace of
eigenvalues above the shift and -1 below.  (sign + 1) / 2 projects on the former;
bases of the two subspaces split the matrix in two, and each half is split again
until it is a number, or a multiple of the identity.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps


def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by QR-based dynamically weighted Halley steps.

    Each step maps the singular values x to x (a + b x^2) / (1 + c x^2) with the
    weights that suit their least value; from 1e-16 they are 1 after six steps.
    """
    n = len(a)
    x = a / np.linalg.norm(a)
    least = max(1 / np.linalg.cond(a), _EPS) / np.sqrt(n)
    one = np.eye(n)
    for _ in range(40):
        s = least * least
        d = np.cbrt(4 * (1 - s) / (s * s)) if s < 1 else 0.0
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(8 - 4 * d + 8 * (2 - s) / (s * root)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.concatenate([np.sqrt(wc) * x, one]))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        step = np.linalg.norm(new - x)
        x = new
        least = min(1.0, least * (wa + wb * s) / (1 + wc * s))
        if step < 10 * np.sqrt(n) * _EPS or (step < np.cbrt(_EPS) and 1 - least < 10 * _EPS):
            break
    return x


def _split(a: np.ndarray) -> tuple[np.ndarray, int]:
    """An orthogonal basis whose first columns span the eigenvalues above a shift, and how many these are."""
    n = len(a)
    noise = np.random.default_rng(n).standard_normal((n, n))
    mean = np.trace(a) / n
    best = None
    # The middle of the diagonal halves most matrices; the mean lies strictly inside any spectrum; both may meet an eigenvalue.
    low, high = a.diagonal().min(), a.diagonal().max()
    for shift in (np.median(a.diagonal()), mean, *(mean + (high - low) * t for t in (0.03, -0.03, 0.1, -0.1))):
        moved = a - shift * np.eye(n)
        if not np.any(moved):
            continue
        project = (polar_factor(moved) + np.eye(n)) / 2
        k = round(np.trace(project))
        if not 0 < k < n:
            continue
        q, _ = np.linalg.qr(project @ noise[:, :k])
        q, _ = np.linalg.qr(project @ q)
        q = np.linalg.qr(q, mode="complete")[0]
        off = np.linalg.norm(q[:, :k].T @ a @ q[:, k:])
        if best is None or off < best[0]:
            best = off, q, k
        if off <= 4 * n * _EPS * np.linalg.norm(a):
            break
    return (best[1], best[2]) if best else (np.eye(n), 0)


def _parts(a: np.ndarray, basis: np.ndarray, small: float, out: list[np.ndarray]) -> None:
    n = len(a)
    if n == 1 or np.linalg.norm(a - np.trace(a) / n * np.eye(n)) <= small:
        out.append(basis)
        return
    q, k = _split(a)
    if not k:  # no shift parts it: its eigenvalues are equal to rounding
        out.append(basis)
        return
    turned = q.T @ a @ q
    turned = (turned + turned.T) / 2
    _parts(turned[:k, :k], basis @ q[:, :k], small, out)
    _parts(turned[k:, k:], basis @ q[:, k:], small, out)


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    The entry of an eigenvector that is largest in size is positive.
    """
    a = (a + a.T) / 2
    out: list[np.ndarray] = []
    _parts(a, np.eye(len(a)), _EPS * np.linalg.norm(a), out)
    v = np.concatenate(out, axis=1)
    e = np.einsum("ij,ij->j", v, a @ v)
    order = np.argsort(-e, kind="stable")
    v = v[:, order]
    top = np.abs(v).argmax(axis=0)
    return e[order], v * np.sign(v[top, np.arange(len(a))])
