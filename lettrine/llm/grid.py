"""Vectors on a grid of whole numbers, for quantisers that work exactly.

Kept are rows whose vector is there and holds no null and no non-finite number.
A component x becomes floor(scale * x); what would lie beyond ``largest`` counts
as that, so that squared distances stay within 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def largest(dim: int) -> int:
    """2^26 for 64 components: a squared distance is then at most 2^60."""
    return 1 << ((60 - dim.bit_length()) // 2)


def kept(vectors: DataFrame, *columns: str) -> DataFrame:
    """vec_id, the columns named and embedding, in double precision; other columns stay out."""
    x = F.col("embedding").cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.where(x.isNotNull() & ~odd).select("vec_id", *columns, x.alias("embedding"))


def whole(lists: pa.Array, dim: int, scale: int) -> np.ndarray:
    """Rows x components of an Arrow column of lists of ``dim`` numbers."""
    values = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    top = largest(dim)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * scale), -top, top).astype(np.int64)


def lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow column of lists, one for each row of a matrix."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)), pa.array(rows.ravel(), kind))


def floor_mean(sums: np.ndarray, count: int) -> list[int]:
    return [int(s) // int(count) for s in sums]
