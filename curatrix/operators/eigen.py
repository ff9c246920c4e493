"""Leading eigenpairs of symmetric operators that are only known by their products, as passes over a table give them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Columns beside the wanted ones in a block, columns of a basis before it is started anew, and blocks at most.
SPARE, MOST_BASIS, MOST_BLOCKS = 4, 96, 400
#: Bytes of a basis and its image, unless four blocks take more.
BASIS_BYTES = 256 << 20


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Columns of ``block`` orthonormal to each other and to ``against``; those that vanish go."""
    size = np.linalg.norm(block, axis=0)
    for _ in range(2):  # once more for the digits that the first time loses
        block = block - against @ (against.T @ block)
    left = np.linalg.norm(block, axis=0)
    block = block[:, left > 1e-12 * np.maximum(size, 1e-300)]
    if not block.shape[1]:
        return block
    u, s, _ = np.linalg.svd(block / np.linalg.norm(block, axis=0), full_matrices=False)
    u = u[:, s > 1e-10 * s[0]]
    u = u - against @ (against.T @ u)
    return np.linalg.qr(u)[0]


def leading(times: Callable[[np.ndarray], np.ndarray], n: int, k: int, start: np.ndarray | None = None, tol: float = 1e-10, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues (by value) and their vectors, by block Lanczos with full orthogonalisation.

    ``times`` gives the product with a few columns; a call is a pass. ``start`` are columns thought to be near the wanted
    ones. A basis that grows too wide is started anew from its best vectors. The driver holds ``n`` by MOST_BASIS numbers, twice.
    """
    k = min(k, n)
    wide = min(n, k + SPARE)
    first = np.random.default_rng(seed).normal(size=(n, wide))
    if start is not None and start.shape[1]:
        first = np.hstack([start, first])[:, : max(wide, start.shape[1])]
    block = _orthonormal(first, np.zeros((n, 0)))
    basis, image = np.zeros((n, 0)), np.zeros((n, 0))
    most = max(min(MOST_BASIS, BASIS_BYTES // (16 * n)), 4 * wide)
    for _ in range(MOST_BLOCKS):
        basis, image = np.hstack([basis, block]), np.hstack([image, times(block)])
        t = basis.T @ image
        w, s = np.linalg.eigh((t + t.T) / 2)
        order = np.argsort(-w)
        w, s = w[order], s[:, order]
        vectors, images = basis @ s[:, :wide], image @ s[:, :wide]
        off = images - vectors * w[: vectors.shape[1]]
        scale = max(float(np.abs(w).max()), 1e-300)
        settled = vectors.shape[1] >= k and np.linalg.norm(off[:, :k], axis=0).max() <= tol * scale
        if settled or basis.shape[1] >= n:
            return w[:k], vectors[:, :k]
        if basis.shape[1] + wide > most:
            basis, image = vectors, images
            block = _orthonormal(off, basis)
        else:
            block = _orthonormal(image[:, -block.shape[1] :], basis)
        if not block.shape[1]:
            if basis.shape[1] >= k:
                return w[:k], vectors[:, :k]
            block = _orthonormal(np.random.default_rng(seed + 1).normal(size=(n, wide)), basis)
    raise RuntimeError(f"{k} eigenpairs did not settle in {MOST_BLOCKS} passes")
