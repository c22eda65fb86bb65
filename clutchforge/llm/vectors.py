"""Vectors of a table as rows without gaps and as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONG_MAX = (1 << 63) - 1
FAR = 1 << 62  # quantised components end here


def finite_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id, v (array of doubles): the rows whose vector is not null and holds only finite numbers."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")) \
        .filter(F.col("v").isNotNull() & finite)


def longest(vectors: DataFrame) -> int:
    """The number of components; shorter vectors count as having zeros at their end."""
    return vectors.agg(F.max(F.size("v"))).first()[0] or 0


def matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """One row of ``dims`` doubles per list."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    ends = lists.offsets.to_numpy().astype(np.int64)
    sizes, values = np.diff(ends), lists.values.to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), dims))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(ends[:-1] - ends[0], sizes)] = values[ends[0]:ends[-1]]
    return out


def scaled_floor(v: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * v) as longs; values beyond +-2**62 end there."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * v), -float(FAR), float(FAR)).astype(np.int64)
