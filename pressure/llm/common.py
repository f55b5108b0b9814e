"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters that a task expands into arrays at one time; a longer text is a slice of its own.
SLICE_CHARS = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(sizes: np.ndarray, limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) whose sizes add up to at most `limit`, or that hold one row."""
    ends = np.cumsum(sizes, dtype=np.int64)
    a, n = 0, len(sizes)
    while a < n:
        before = int(ends[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield a, b
        a = b


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every run, one after the other."""
    lengths = lengths.astype(np.int64, copy=False)
    total = int(lengths.sum())
    shift = np.repeat(starts.astype(np.int64, copy=False) - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(total, dtype=np.int64) + shift


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: str | Column) -> Column:
    """Rows that models may not learn from: crc32 of the id as text, modulo 3, is 1; never null."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def shared(spark: SparkSession, value: Any):
    """A broadcast value of bounded size: a model, a vocabulary, a table of slots."""
    return spark.sparkContext.broadcast(value)
