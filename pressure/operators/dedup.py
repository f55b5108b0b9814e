"""Exact duplicate removal and counting. Unknown values count as equal.

Removal sends each row once, copies collapsed. Counting reads the rows twice and sends fingerprints of 128 bits; full
rows are compared where fingerprints meet, so a collision costs work and never changes a result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressure.sources.scratch import keep

_FINGERPRINT = ("_print_1", "_print_2")


def fingerprint(columns: Sequence[str]) -> list[Column]:
    """Two hashes of a row. A hash passes over unknown values, so what is unknown is hashed as well.

    Structs are hashed by functions of their own; hashed one by one, many columns make a method that stays uncompiled.
    """
    values = [F.col(f"`{c}`") for c in columns]
    row = F.struct(F.struct(*values), F.struct(*[v.isNull() for v in values]))
    return [F.xxhash64(F.lit(seed), row) for seed in range(len(_FINGERPRINT))]


def _content(df: DataFrame, row_id: str | None) -> list[str]:
    return [c for c in df.columns if c != row_id]


def first_of_equals(df: DataFrame, row_id: str) -> DataFrame:
    """One row per set of rows that agree on everything but `row_id`, keeping the lowest id.

    Copies collapse inside each task before the shuffle, so a row repeated any number of times travels once per task.
    """
    content = [F.col(f"`{c}`") for c in _content(df, row_id)]
    return df.groupBy(*content).agg(F.min(row_id).alias(row_id)).select(*[F.col(f"`{c}`") for c in df.columns])


def repeated(df: DataFrame, row_id: str | None = None) -> DataFrame:
    """How often (`_n`) each row that may have copies occurs. Rows left out occur once.

    The fingerprints that several rows have are written, so Spark knows their size: few are broadcast, and then only
    rows that have one are shuffled, copies collapsed; many are joined by shuffle.
    """
    content = _content(df, row_id)
    marked = df.withColumns(dict(zip(_FINGERPRINT, fingerprint(content), strict=True)))
    counts = marked.groupBy(*_FINGERPRINT).agg(F.count("*").alias("_n"))
    several = keep(counts.where("_n > 1").select(*_FINGERPRINT), "fingerprints")
    meeting = marked.join(several, list(_FINGERPRINT), "left_semi")
    return meeting.groupBy(*[F.col(f"`{c}`") for c in content]).agg(F.count("*").alias("_n")).select("_n")


def extra_copies(df: DataFrame, row_id: str | None = None) -> DataFrame:
    """One row with the number of rows that repeat an earlier one."""
    return repeated(df, row_id).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates"))
