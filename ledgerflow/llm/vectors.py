"""Vector columns in tasks: reading, validity, and the exact cosine."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: str) -> Column:
    """True for vectors that can be compared: no null or non-finite component,
    and not zero."""
    v = F.col(vector)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda c: c != 0), F.lit(False))


def dtype_of(df: DataFrame, vector: str) -> str:
    """numpy type of the components."""
    return "<f4" if df.schema[vector].dataType.elementType.simpleString() == "float" else "<f8"


def matrices(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each vector length in a list column without nulls."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    lengths = np.diff(offsets)
    flat = column.values.to_numpy(zero_copy_only=False)
    out = []
    for size in np.unique(lengths).tolist():
        rows = np.nonzero(lengths == size)[0]
        out.append((rows, flat[offsets[rows][:, None] + np.arange(size)]))
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, as doubles (safe for very large or small
    components)."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``, in double
    precision, summed in the order of the components, so that equal vectors
    have equal scores wherever they are compared."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    dot, na, nb = (np.zeros(len(a)) for _ in range(3))
    for j in range(a.shape[1]):
        dot += a[:, j] * b[:, j]
        na += a[:, j] * a[:, j]
        nb += b[:, j] * b[:, j]
    with np.errstate(all="ignore"):
        out = dot / np.sqrt(na * nb)
    odd = ~np.isfinite(out) | (na * nb < 1e-280)
    if odd.any():   # squares out of range: scale first
        out[odd] = (unit(a[odd]) * unit(b[odd])).sum(axis=1)
    return np.clip(out, -1.0, 1.0)
