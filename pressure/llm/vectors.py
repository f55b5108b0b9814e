"""What the operators on embeddings share: which vectors take part, and rows as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not empty, no null or non-finite component, and not all zero; never null itself."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def read_vectors(vectors: DataFrame, id_column: str, vector_column: str, *rest: str) -> DataFrame:
    """(id, vector array<double>, others) of the rows that have an id and a usable vector."""
    picked = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("vector"), *rest)
    return picked.where(F.col("id").isNotNull() & usable(F.col("vector")))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of equal length as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def by_length(column: pa.Array) -> list[np.ndarray]:
    """Row numbers of the lists of each length."""
    lengths = np.diff(column.offsets.to_numpy())
    return [np.flatnonzero(lengths == n) for n in np.unique(lengths)]
