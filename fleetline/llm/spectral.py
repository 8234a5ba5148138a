"""Eigenvectors of a symmetric matrix by spectral divide and conquer.

The polar factor of ``H - shift I`` (QR-based dynamically weighted Halley
iterations, QDWH) is the matrix sign function: it has the eigenvectors of
``H`` with eigenvalue 1 above the shift and -1 below.  So ``(U + I) / 2``
projects on the invariant subspace above the shift.  A basis of it and one of
its complement split ``H`` into two smaller matrices, and so on down to single
components.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
ITERATIONS = 12


def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by QDWH.

    ``low`` follows a lower bound of the smallest singular value; beginning
    with the machine's precision it reaches 1 in six steps.
    """
    size = np.linalg.norm(a)
    if size == 0:
        return np.zeros_like(a)
    x, low = a / size, EPS
    identity = np.eye(len(a))
    for _ in range(ITERATIONS):
        square = low * low
        root = np.cbrt(4 * (1 - square) / (square * square))
        first = np.sqrt(1 + root)
        wa = first + np.sqrt(8 - 4 * root + 8 * (2 - square) / (square * first)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, identity]))
        upper, lower = q[:len(a)], q[len(a):]
        after = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (upper @ lower.T)
        after = (after + after.T) / 2
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        change = np.linalg.norm(after - x)
        x = after
        if abs(1 - low) < 10 * EPS and change <= np.cbrt(EPS):
            break
    return x


def split(h: np.ndarray, shift: float):
    """(basis above the shift, basis below, size of what couples them); None
    if the shift has nothing on one side."""
    n = len(h)
    projector = (polar_factor(h - shift * np.eye(n)) + np.eye(n)) / 2
    above = int(round(np.trace(projector)))
    if not 0 < above < n:
        return None
    probe = np.random.default_rng(0).standard_normal((n, above))
    basis, _ = np.linalg.qr(projector @ probe)
    both, _ = np.linalg.qr(projector @ basis, mode="complete")
    one, other = both[:, :above], both[:, above:]
    return one, other, float(np.linalg.norm(other.T @ h @ one))


def shifts(h: np.ndarray) -> list[float]:
    """Where to try a split: amid the diagonal, at its mean (which always has
    eigenvalues on both sides) and at the other steps of the diagonal, in case
    an eigenvalue lies at one of those."""
    diagonal = np.sort(np.diag(h))
    middle = (diagonal[1:] + diagonal[:-1]) / 2
    near = np.argsort(np.abs(np.arange(len(middle)) - len(middle) / 2), kind="stable")
    return [float(np.median(diagonal)), float(np.trace(h) / len(h)), *middle[near[:6]].tolist()]


def components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric
    matrix.  A vector's largest entry is positive."""
    n, scale = len(v), np.linalg.norm(v)
    good, flat = 50 * EPS * scale, 10 * EPS * scale
    done: list[np.ndarray] = []
    open_ = [np.eye(n)]
    while open_:
        basis = open_.pop()
        h = basis.T @ v @ basis
        h = (h + h.T) / 2
        if np.linalg.norm(h - np.diag(np.diag(h))) <= flat:
            done.append(basis)
            continue
        best = None
        for shift in shifts(h):
            parts = split(h, shift)
            if parts and (best is None or parts[2] < best[2]):
                best = parts
            if best and best[2] <= good:
                break
        if best is None:            # equal eigenvalues, up to rounding
            done.append(basis)
            continue
        open_ += [basis @ best[0], basis @ best[1]]
    vectors = np.hstack(done) if done else np.zeros((0, 0))
    vectors /= np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    largest = np.argmax(np.abs(vectors), axis=0)
    return values, vectors * np.where(vectors[largest, np.arange(n)] < 0, -1.0, 1.0)
