"""Largest eigenpairs of a symmetric matrix that is known by its products only: Jacobi-Davidson."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

EPS = np.finfo(float).eps
Product = Callable[[np.ndarray], np.ndarray]  # a block of columns to the matrix times the block


def _orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of ``block`` have outside of the bases given; it may have fewer columns."""
    basis = np.concatenate(against, axis=1) if against else np.zeros((len(block), 0))
    kept: list[np.ndarray] = []
    for column in block.T:
        size = np.linalg.norm(column)
        if not size:
            continue
        column = column / size
        for _ in range(3):  # repeated, so that rounding leaves no part of the bases
            column = column - basis @ (basis.T @ column)
            for other in kept:
                column = column - other * (other @ column)
            size = np.linalg.norm(column)
            if size < 1e-10:
                break
            column = column / size
        else:
            kept.append(column)
    return np.stack(kept, axis=1) if kept else np.zeros((len(block), 0))


def minres(product: Product, shifts: np.ndarray, out: np.ndarray, right: np.ndarray, steps: int, tol: float) -> np.ndarray:
    """Approximate solutions t, one per column, of P(A - shift)P t = right, where P projects ``out`` away.

    All columns take their steps together, so that a step is one product.  Lanczos vectors
    are short recurrences; Givens rotations keep the residual minimal at every step.  A
    column stops at ``steps`` or when its residual is ``tol`` of its right side.
    """

    def project(block: np.ndarray) -> np.ndarray:
        block = block - out @ (out.T @ block)
        return block - out @ (out.T @ block)

    v = project(right)
    first = np.linalg.norm(v, axis=0)
    beta = first.copy()
    v = v / np.where(beta > 0, beta, 1)
    solution, rest = np.zeros_like(v), first.copy()
    v_old, d_old, d_older = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    k = v.shape[1]
    cos, sin, cos_old, sin_old = np.ones(k), np.zeros(k), np.ones(k), np.zeros(k)
    beta_now = np.zeros(k)
    live = first > 0
    for _ in range(steps):
        if not live.any():
            break
        w = np.zeros_like(v)
        w[:, live] = product(v[:, live])
        w = project(w - v * shifts) - v_old * beta_now
        alpha = (v * w).sum(0)
        w = w - v * alpha
        beta_next = np.linalg.norm(w, axis=0)
        # The new column of the tridiagonal matrix, turned by the last two rotations and by one of its own.
        epsilon = sin_old * beta_now
        delta_bar = cos_old * beta_now
        delta = cos * delta_bar + sin * alpha
        gamma_bar = cos * alpha - sin * delta_bar
        gamma = np.hypot(gamma_bar, beta_next)
        safe = np.where(gamma > 0, gamma, 1)
        cos_old, sin_old = cos, sin
        cos, sin = np.where(gamma > 0, gamma_bar / safe, 1.0), np.where(gamma > 0, beta_next / safe, 0.0)
        d = (v - d_old * delta - d_older * epsilon) / safe
        step = np.where(live & (gamma > 0), cos * rest, 0.0)
        solution = solution + d * step
        rest = rest * np.where(live, -sin, 1.0)
        live = live & (np.abs(rest) > tol * first) & (beta_next > EPS * np.abs(shifts))
        v_old, v = v, w / np.where(beta_next > 0, beta_next, 1)
        d_older, d_old, beta_now = d_old, d, beta_next
    return project(solution)


def largest_eigenpairs(
    product: Product, size: int, wanted: int, inner: int = 3, most_rounds: int = 100, seed: int = 7
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, their unit eigenvectors as columns, and the residuals' norms.

    A subspace starts with random directions.  Every round takes the Ritz pairs of the
    subspace (Rayleigh-Ritz), locks those at the top whose residual has reached double
    precision, and solves for each of the others that are wanted the projected correction
    equation by a few steps of MINRES.  The corrections widen the subspace; when it gets
    large it starts again from its best Ritz vectors.  It ends when all wanted are locked,
    or when the subspace is the whole space: its Ritz pairs are then exact up to rounding.
    """
    wanted = min(wanted, size)
    most = min(size, max(96, 12 * wanted))
    random = np.random.default_rng(seed)
    basis = _orthonormal(random.standard_normal((size, min(size, 2 * wanted))))
    image = product(basis)
    locked, best = 0, np.inf
    for _ in range(most_rounds):
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, moved = basis @ turn[:, :wanted], image @ turn[:, :wanted]
        residual = moved - ritz * values[:wanted]
        norms = np.linalg.norm(residual, axis=0)
        scale = max(abs(values[0]), abs(values[-1]))
        done = norms <= 32 * EPS * scale
        locked = int(np.argmin(done)) if not done.all() else wanted
        # Rounding of the products may stop the residuals just above the bound.
        stuck = norms.max() < 1e3 * EPS * scale and norms.max() > 0.5 * best
        best = min(best, norms.max())
        if locked == wanted or stuck or basis.shape[1] == size or not scale:
            break
        if basis.shape[1] + 2 * (wanted - locked) > most and most < size:
            keep = min(4 * wanted, basis.shape[1])
            basis, image = basis @ turn[:, :keep], image @ turn[:, :keep]
        left = slice(locked, wanted)
        correction = minres(product, values[left], ritz, -residual[:, left], inner, 1e-3)
        wider = _orthonormal(np.concatenate([correction, residual[:, left]], axis=1), basis)
        if not wider.shape[1]:
            wider = _orthonormal(random.standard_normal((size, wanted - locked)), basis)
        wider = wider[:, : size - basis.shape[1]]
        basis, image = np.concatenate([basis, wider], axis=1), np.concatenate([image, product(wider)], axis=1)
    else:
        raise RuntimeError(f"eigenpairs did not reach double precision in {most_rounds} rounds")
    return values[:wanted], ritz, norms
