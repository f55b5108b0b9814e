"""Handing a reduced result to Python. Use these on reports, never on event tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame


def values(df: DataFrame) -> list[Any]:
    """The first column as a list."""
    return [row[0] for row in df.collect()]


def records(df: DataFrame) -> list[dict[str, Any]]:
    return [row.asDict() for row in df.collect()]


def single(df: DataFrame) -> dict[str, Any]:
    """The one row of a summary."""
    return df.first().asDict()
