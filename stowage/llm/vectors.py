"""Columns of vectors as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def matrices(vectors: pa.Array | pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The usable vectors of a column by length: their rows, and a matrix of doubles.

    A vector that is null, empty or zero, or holds nulls or non-finite numbers, is left out.
    """
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    flat = vectors.flatten().cast(pa.float64())
    values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == length)
        x = values[starts[rows][:, None] + np.arange(length)]
        with np.errstate(over="ignore"):
            norm = (x * x).sum(1)
        good = np.isfinite(x).all(1) & (norm > 0) & np.isfinite(norm)
        if good.any():
            yield rows[good], x[good]


def unpack(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The matrix of vectors of one length that travelled as bytes of doubles."""
    return np.array([np.frombuffer(v.as_py(), np.float64) for v in column]).reshape(len(column), -1)
