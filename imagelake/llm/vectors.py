"""Vectors as Arrow columns: rows of numbers as NumPy arrays, and which of them are whole."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def whole_vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Each row of a list column as float64, or None where the row, or one of its
    numbers, is null or not finite."""
    offsets = column.offsets.to_numpy()
    values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    out: list[np.ndarray | None] = []
    for ok, lo, hi in zip(valid, offsets[:-1], offsets[1:]):
        v = values[lo:hi]
        out.append(v if ok and np.isfinite(v).all() else None)
    return out


def matrix(packed: list[bytes], width: int, dtype: str = "<f8") -> np.ndarray:
    """Packed vectors as rows of float64, shorter ones with zeros behind."""
    out = np.zeros((len(packed), width))
    size = np.dtype(dtype).itemsize
    if packed and all(len(p) == width * size for p in packed):
        out[:] = np.frombuffer(b"".join(packed), dtype).reshape(-1, width)
    else:
        for row, p in zip(out, packed):
            row[:len(p) // size] = np.frombuffer(p, dtype)
    return out
