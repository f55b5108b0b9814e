"""Profiles of raw files, numbers only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressure.operators import profile as P
from pressure.operators.dedup import extra_copies
from pressure.sources.csv_log import fixed_splits, read_csv, read_csv_by_file, with_block
from pressure.sources.scratch import keep

COORDINATES = ["X Coordinate", "Y Coordinate"]


@dataclass(frozen=True)
class Profile:
    columns: list[tuple[str, str]]
    shape: DataFrame
    nulls: DataFrame
    duplicates: DataFrame
    describe: DataFrame
    events: DataFrame


def profile_table(df: DataFrame) -> Profile:
    """Size, gaps, repeated rows, number summaries and event names of raw rows."""
    return Profile(
        P.column_types(df),
        P.shape(df),
        P.nulls(df),
        extra_copies(df),
        P.describe(df, P.numeric_columns(df)),
        P.distinct_values(df, "Event"),
    )


def profile_file(spark: SparkSession, path: str) -> Profile:
    return profile_table(read_csv(spark, path))


def first_rows(spark: SparkSession, path: str, first: int, columns: Sequence[str]) -> DataFrame:
    """(file, event_id, columns) of the first rows of every file, with their number in the whole log.

    A file's first rows are the first ones of the block that starts it, and the rows of earlier files are
    counted, so nothing is sorted or written but the rows that are shown.
    """
    rows = read_csv_by_file(spark, path)
    with fixed_splits(spark):
        sizes = keep(rows.groupBy("file").agg(F.count("*").alias("rows")), "files")
        earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
        before = sizes.select(F.col("file").alias("_file"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_before"))
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
        placed = with_block(rows).select("file", "_start", place.alias("_place"), *columns)
        shown = placed.filter((F.col("_start") == 0) & (F.col("_place") <= first)).join(before, F.col("file") == F.col("_file"))
        return keep(shown.select("file", (F.col("_place") + F.col("_before")).alias("event_id"), *columns), "first-rows")


def profile_folder(spark: SparkSession, path: str, first: int = 3) -> dict[str, DataFrame]:
    """Rows, event counts, coordinate extents and first clocks per file, straight from the files."""
    df = read_csv_by_file(spark, path)
    return {
        "rows": df.groupBy("file").agg(F.count("*").alias("rows")),
        "events": df.filter(F.col("Event").isNotNull())
        .groupBy("file", "Event")
        .agg(F.count("*").alias("n"))
        .orderBy("file", F.desc("n"), "Event"),
        "extent": df.groupBy("file").agg(
            *[agg(c).alias(f"{c} {n}") for c in COORDINATES for n, agg in (("min", F.min), ("max", F.max))]
        ),
        "clocks": first_rows(spark, path, first, ["Clock"]).orderBy("event_id"),
    }
