"""Vectors as packed rows: valid ones only, tiles of many in one binary value."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid_vector(v: Column, dims: int) -> Column:
    """Neither null nor zero, of ``dims`` components, all finite."""
    inf = float("inf")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    return F.coalesce(v.isNotNull() & (F.size(v) == dims) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def element_type(df: DataFrame, vec_col: str) -> str:
    """``float`` for vectors of floats, else ``double``: components keep all their digits."""
    return "float" if df.schema[vec_col].dataType.simpleString() == "array<float>" else "double"


def as_matrix(column: pa.Array, dims: int) -> np.ndarray:
    """An Arrow list column without nulls as a float64 matrix."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dims)


def unit(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow for large components."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def unpack(raw: bytes, dtype: str, dims: int = 1) -> np.ndarray:
    a = np.frombuffer(raw, dtype=dtype)
    return a.reshape(-1, dims) if dims > 1 else a


def batches_by_run(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Consecutive rows with equal leading key (column 0), at most ``limit`` at a time."""
    key, held, n = None, [], 0
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(0).to_numpy(zero_copy_only=False)
        edges = np.r_[0, np.flatnonzero(k[1:] != k[:-1]) + 1, len(k)]
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if n and k[lo] != key:
                yield key, pa.Table.from_batches(held)
                held, n = [], 0
            key = k[lo].item()
            while lo < hi:
                take = min(hi - lo, limit - n)
                held.append(b.slice(lo, take))
                n += take
                lo += take
                if n == limit:
                    yield key, pa.Table.from_batches(held)
                    held, n = [], 0
    if n:
        yield key, pa.Table.from_batches(held)
