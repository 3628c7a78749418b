"""Helpers for tables of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(v: Column) -> Column:
    """True for vectors with a direction: no null, no null or non-finite component, not zero or empty."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Equally long vectors as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def shifted(rows: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component between 1/2 and 1.

    No digit of a normal number changes, and no square over- or underflows.
    """
    if not rows.size:
        return rows
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(1, keepdims=True))[1])


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (largest component first, so that no square overflows)."""
    if not rows.size:
        return rows
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


