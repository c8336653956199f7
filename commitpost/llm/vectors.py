"""Vectors of many rows at once: numpy matrices over an Arrow column of lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

REACH = 2.0**16
"""A component of this magnitude or more counts as not finite, so that whole-number products stay exact."""


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, matrix)`` of the usable vectors, one pair for each length; matrices are of doubles.

    A vector is usable if it is not null and all its components are finite numbers below ``REACH``.
    """
    if not len(column):
        return
    offsets = np.asarray(column.offsets, np.int64)
    values = np.asarray(column.values.cast(pa.float64()).fill_null(np.nan), np.float64)
    there = np.asarray(column.is_valid())
    lengths = np.where(there, np.diff(offsets), -1)
    for length in np.unique(lengths[there]):
        rows = np.flatnonzero(lengths == length)
        found = values[offsets[rows][:, None] + np.arange(length)]
        usable = (np.abs(found) < REACH).all(axis=1)
        if usable.any():
            yield rows[usable], found[usable]


def whole(matrix: np.ndarray, times: int) -> np.ndarray:
    """floor(times * component), exact for a power of two."""
    return np.floor(matrix * times).astype(np.int64)
