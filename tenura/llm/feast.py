"""Leading eigenpairs of a symmetric matrix by contour integration over intervals of its spectrum.

The number of eigenvalues above a shift is the number of positive pivots of the shifted matrix (Sylvester's law of inertia). Such
counts cut the wanted part of the spectrum into intervals of few eigenvalues each, with their ends in gaps. For an interval, quadrature of the resolvent along a
circle through its ends projects a block of vectors onto its eigenspace: each node is a solve with a complex shifted matrix.
Rayleigh-Ritz on the projected block gives eigenpairs, and the step is repeated until they are exact to rounding. The pairs
found in an interval must be as many as the counts say, else the block is enlarged.

Intervals do not depend on each other; ``whitening`` solves each in a task of its own.
"""

from __future__ import annotations

import numpy as np

# Eigenvalues aimed at in an interval.
INTERVAL = 8
# Quadrature nodes on the upper half of the circle; the lower half is their mirror image.
NODES = 12
_STEPS = 30
# Residuals, against the norm, that count as found; the steps go on while they get smaller.
_CLOSE = 1e-11


class Inertia:
    """Counts of eigenvalues beyond a shift; the matrix is brought to three diagonals once, which keeps its eigenvalues."""

    def __init__(self, v: np.ndarray):
        a = np.array(v, float)
        n = len(a)
        for k in range(n - 2):
            # The reflection that clears column k below its second diagonal, applied on both sides.
            x = a[k + 1 :, k].copy()
            x[0] += np.copysign(np.linalg.norm(x), x[0])
            size = np.linalg.norm(x)
            if size == 0:
                continue
            u = x / size
            p = a[k + 1 :, k + 1 :] @ u
            w = 2 * (p - (u @ p) * u)
            a[k + 1 :, k + 1 :] -= np.outer(u, w) + np.outer(w, u)
            a[k + 1 :, k] -= 2 * (u @ a[k + 1 :, k]) * u
            a[k, k + 1 :] = a[k + 1 :, k]
        self.main, self.beside = np.diag(a).tolist(), (np.diag(a, 1) ** 2).tolist()

    def above(self, shift: float) -> int:
        """How many eigenvalues are greater than ``shift``: the positive pivots of the shifted matrix."""
        count, pivot = 0, 1.0
        tiny = np.finfo(float).tiny
        for at, x in enumerate(self.main):
            pivot = x - shift - (self.beside[at - 1] / pivot if at else 0.0)
            if abs(pivot) < tiny:
                pivot = -tiny
            count += pivot > 0
        return count


def least_size(v: np.ndarray) -> float:
    """Eigenvalues up to this size cannot be told from zero."""
    return len(v) * np.finfo(float).eps * 8 * float(np.abs(v).sum(axis=1).max(initial=0.0))


def _edge(inertia: Inertia, k: int, low: float, high: float) -> float:
    """About the ``k``-th greatest eigenvalue, by counts: ``k`` or more lie above ``low``, fewer above ``high``."""
    for _ in range(48):
        middle = (low + high) / 2
        if inertia.above(middle) >= k:
            low = middle
        else:
            high = middle
    return (low + high) / 2


def intervals(v: np.ndarray, wanted: int, each: int = INTERVAL) -> list[tuple[float, float, int]]:
    """(low, high, number of eigenvalues) of intervals, from above, that hold the ``wanted`` greatest ones that are not zero.

    An interval ends in the widest gap that follows its first ``each`` eigenvalues or up to half as many more.
    """
    top = float(np.abs(v).sum(axis=1).max(initial=0.0)) * (1 + 1e-9)
    floor, inertia = least_size(v), Inertia(v)
    total = inertia.above(floor)
    out: list[tuple[float, float, int]] = []
    high, done = top, 0
    while done < min(wanted, total):
        first = min(done + each, wanted, total)
        last = min(first + each // 2, total)
        edges = [_edge(inertia, k, floor, high) for k in range(first, last + 1)]
        edges.append(_edge(inertia, last + 1, floor, edges[-1]) if last < total else floor)
        gap = [a - b for a, b in zip(edges, edges[1:])]
        at = int(np.argmax(gap))
        low = (edges[at] + edges[at + 1]) / 2
        # Equal eigenvalues leave no gap: those that lie above the end are taken as they are counted.
        found = inertia.above(low)
        if found <= done or gap[at] <= floor:
            low, found = floor, total
        out.append((low, high, int(found - done)))
        done, high = found, low
    return out


def eigenpairs(v: np.ndarray, low: float, high: float, count: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues in (low, high], falling, with unit eigenvectors as columns."""
    n = len(v)
    size = min(n, 2 * count + 8)
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turn = np.pi / 2 * (nodes + 1)
    scale = float(np.abs(v).sum(axis=1).max())
    rng = np.random.default_rng(seed)
    block = np.linalg.qr(rng.standard_normal((n, size)))[0]
    best = None
    for step in range(_STEPS):
        projected = np.zeros_like(block)
        for angle, weight in zip(turn, weights):
            z = centre + radius * np.exp(1j * angle)
            solved = np.linalg.solve(z * np.eye(n) - v, block.astype(complex))
            projected += weight / 2 * np.real(radius * np.exp(1j * angle) * solved)
        basis = np.linalg.qr(projected)[0]
        values, inner = np.linalg.eigh(basis.T @ v @ basis)
        block = basis @ inner
        inside = np.flatnonzero((values > low) & (values <= high))
        left = np.linalg.norm(v @ block[:, inside] - block[:, inside] * values[inside], axis=0).max(initial=0.0)
        if len(inside) == count and (best is None or left < 0.5 * best[0]):
            best = (left, values[inside], block[:, inside])
        elif best is not None and best[0] < _CLOSE * scale:
            break
        elif step % 4 == 3 and size < n:
            # Some are missing or far off: a larger block.
            size = min(n, 2 * size)
            block = np.linalg.qr(np.hstack([block, rng.standard_normal((n, size - block.shape[1]))]))[0]
    if best is None or best[0] >= _CLOSE * scale:
        raise ArithmeticError(f"found no {count} eigenvalues between {low} and {high}")
    return best[1][::-1], best[2][:, ::-1]


def united(v: np.ndarray, vectors: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh-Ritz over the vectors of all intervals: falling eigenvalues, and vectors at right angles to each other."""
    basis = np.linalg.qr(vectors)[0]
    values, inner = np.linalg.eigh(basis.T @ v @ basis)
    return values[::-1][:wanted], (basis @ inner)[:, ::-1][:, :wanted]
