"""What the vector operators share: which rows take part, and arrays in and out of Arrow."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows (id long, vec array<double>) that take part.

    Left out: null ids, null and empty vectors, vectors with a null or non-finite component. Rows that
    repeat an id are one row, the smallest vector. All vectors must have the same length.
    """
    vec = F.col(vec_col).cast("array<double>")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).where(
        F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0))
    return rows.where(~bad).groupBy("id").agg(F.min("vec").alias("vec"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(column) and len(flat) % len(column):
        raise ValueError("vectors of different lengths")
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def packed(rows: np.ndarray) -> list[bytes]:
    return [r.tobytes() for r in np.ascontiguousarray(rows)]
