"""Arrow lists of numbers as matrices, and what is asked of a vector."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def matrices(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of doubles) for each length that occurs, of vectors all whose components are finite numbers."""
    sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten()  # without the values of null lists
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes nan
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        matrix = values[starts[rows][:, None] + np.arange(size)]
        good = np.isfinite(matrix).all(axis=1)
        if good.any():
            yield rows[good], matrix[good]


def rotation(size: int, number: int) -> np.ndarray:
    """A random rotation, the same one each time."""
    q, r = np.linalg.qr(np.random.default_rng([size, number]).standard_normal((size, size)))
    return q * np.sign(np.diag(r))
