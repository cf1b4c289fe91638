"""Vectors shared by the embedding operators: which take part, their cosine, binary blocks of rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vec: Column) -> Column:
    """Not null, not empty, not zero, and every component a finite number."""
    d = vec.cast("array<double>")
    finite = F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vec.isNotNull() & finite & F.exists(d, lambda x: x != 0), F.lit(False))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row cosine of two float64 matrices; every sum runs in component order, so that equal
    vectors give equal results wherever they stand."""
    dot, x, y = (np.zeros(len(a)) for _ in range(3))
    for k in range(a.shape[1]):
        dot += a[:, k] * b[:, k]
        x += a[:, k] * a[:, k]
        y += b[:, k] * b[:, k]
    return np.clip(dot / np.sqrt(x * y), -1.0, 1.0)


def unit(m: np.ndarray) -> np.ndarray:
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def pack(m: np.ndarray) -> bytes:
    return np.ascontiguousarray(m).tobytes()


def matrix(data: bytes, dim: int, as_kind: str = "<f8") -> np.ndarray:
    """The matrix, float64 or ``as_kind``, of rows packed as 4-byte or 8-byte floats, told by a leading byte."""
    kind = "<f4" if data[:1] == b"4" else "<f8"
    return np.frombuffer(data, kind, offset=1).reshape(-1, dim).astype(as_kind)


def pack_matrix(m: np.ndarray) -> bytes:
    """Rows as 4-byte floats where that is exact, else as 8-byte ones."""
    short = m.astype("<f4")
    return b"4" + pack(short) if (short == m).all() else b"8" + pack(m.astype("<f8"))
