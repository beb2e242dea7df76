"""Numpy helpers that run inside Spark tasks on one Arrow batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Numbers in one temporary array (8 bytes each).
BLOCK_ELEMENTS = 8_000_000


def to_matrix(column) -> np.ndarray:
    """Rows of an Arrow list column as a dense matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    rows = len(column)
    if rows == 0:
        return np.empty((0, 0))
    if column.null_count:
        raise ValueError("NULL vector")
    return column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(rows, -1)


def from_matrix(matrix: np.ndarray) -> pa.Array:
    """An Arrow list column from the rows of a matrix."""
    rows, width = matrix.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).ravel()))


def nearest_k(x: np.ndarray, y: np.ndarray, y_ids: np.ndarray, k: int):
    """The ``k`` nearest rows of ``y`` for every row of ``x``.

    Yields ``(row of x, id in y, distance)`` arrays, ordered by row, distance,
    id. A matrix product finds the rows that can be among the first k; their
    distances are then taken from differences, so equal vectors get equal
    distances and ties go to the lowest id.
    """
    k = min(k, len(y))
    y_norm = (y * y).sum(axis=1)
    # Even if all of y ties for every row, their differences stay within one array.
    step = max(1, BLOCK_ELEMENTS // max(1, y.size))
    for start in range(0, len(x), step):
        part = x[start:start + step]
        x_norm = (part * part).sum(axis=1)
        rough = x_norm[:, None] - 2.0 * (part @ y.T) + y_norm[None, :]
        slack = 1e-10 * (x_norm + y_norm.max() + 1e-300)
        limit = np.partition(rough, k - 1, axis=1)[:, k - 1] + 2.0 * slack
        rows, cols = np.nonzero(rough <= limit[:, None])
        exact = np.sqrt(((part[rows] - y[cols]) ** 2).sum(axis=1))
        ids = y_ids[cols]
        order = np.lexsort((ids, exact, rows))
        rows, ids, exact = rows[order], ids[order], exact[order]
        first = np.searchsorted(rows, np.arange(len(part)))
        keep = np.arange(len(rows)) - first[rows] < k
        yield rows[keep] + start, ids[keep], exact[keep]


def stack_nearest_k(x: np.ndarray, y: np.ndarray, y_ids: np.ndarray, k: int):
    parts = list(nearest_k(x, y, y_ids, k))
    return tuple(np.concatenate(column) for column in zip(*parts))
