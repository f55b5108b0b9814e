"""CSV files -> rows in file order."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressure.config import LIMITS, Limits
from pressure.sources.schemas import RAW_SCHEMA
from pressure.sources.scratch import keep, keep_counted

Write = Callable[[DataFrame], DataFrame]


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA, multi_line: bool = False
) -> DataFrame:
    """One file, a folder or a glob, with a header. Types are stated by name, never guessed.

    Columns may come in any order, the same in every file; columns the schema does not name are
    kept as text. A wrong header or a malformed value is an error, not a null. `multi_line`
    allows line breaks inside quotes, at the price of one task per file; `ingest_events` cuts such files.
    """
    options = {"header": True, "escape": '"', "multiLine": multi_line}
    layout = file_schema(spark, path, schema, multi_line)
    return spark.read.schema(layout).options(**options, enforceSchema=False, mode="FAILFAST").csv(path)


def file_schema(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA, multi_line: bool = False) -> T.StructType:
    """The columns in the order of the header, with the types of the schema or as text."""
    header = spark.read.options(header=True, escape='"', multiLine=multi_line).csv(path).columns
    absent = [name for name in schema.fieldNames() if name not in header]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    known = {field.name: field for field in schema.fields}
    return T.StructType([known.get(name, T.StructField(name, T.StringType())) for name in header])


def read_csv_by_file(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """The rows with the path of the file each came from."""
    df = read_csv(spark, path, schema)
    return df.withColumn("file", F.col("_metadata.file_path"))


@contextmanager
def fixed_splits(spark: SparkSession) -> Iterator[None]:
    """Reads planned inside cut files at fixed places, however many executors there are, and give each block a task.

    A block is opened at the price of a whole one, so no second block fits into a task.
    """
    names = ("spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum", "spark.sql.files.maxPartitionNum")
    old = {name: spark.conf.get(name, None) for name in names}
    spark.conf.set(names[0], spark.conf.get("spark.sql.files.maxPartitionBytes"))
    for name in names[1:]:
        spark.conf.unset(name)
    try:
        yield
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def numbered_blocks(blocks: DataFrame, limits: Limits = LIMITS) -> tuple[DataFrame, list[str], int]:
    """(blocks with `_before`, the rows of all earlier blocks; the columns to join them by; rows in all).

    Blocks are (path, start, rows); only this table, one row per 128 MB or so, is ever sorted.
    """
    blocks, count = keep_counted(blocks, "blocks")
    earlier = Window.orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    total = blocks.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    # Joined by a hash of path and place, so that a block is two integers, unless two blocks share one.
    on = ["_path", "_start"]
    if placed.select(block_key()).distinct().count() == count:
        placed, on = placed.withColumn("_block", block_key()).drop(*on), ["_block"]
        if count <= limits.broadcast_rows:
            placed = F.broadcast(placed)
    return placed.drop("_rows"), on, total


def block_key() -> Column:
    return F.xxhash64("_path", "_start").alias("_block")


def with_block(df: DataFrame) -> DataFrame:
    """Adds the block that each row of a file scan comes from."""
    return df.select(
        "*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").cast("long").alias("_start")
    )


def write_numbered(rows: DataFrame, name: str, total: int, write: Write) -> DataFrame:
    """Writes rows whose ids must come out as 1 to `total`, and checks on the way that they do."""
    seen = Observation()
    ids = F.sum(F.col(name).cast("decimal(38,0)"))
    written = write(rows.observe(seen, F.count("*").alias("n"), F.max(name).alias("last"), ids.alias("ids")))
    found = seen.get
    if (found["n"], found["last"] or 0, int(found["ids"] or 0)) != (total, total, total * (total + 1) // 2):
        raise RuntimeError(f"{found['n']} rows were read where {total} were counted: the files changed, or were cut anew")
    return written


def with_file_order(
    df: DataFrame, name: str = "event_id", limits: Limits = LIMITS, write: Write = lambda df: keep(df, "file-rows")
) -> DataFrame:
    """Numbers the rows of a file scan 1, 2, 3 ... in file order, several files by path, and writes them.

    A file is read in fixed blocks, each by one task from top to bottom. The rows of each block are counted first,
    without parsing them; a row's number is the rows of all earlier blocks plus its place in its own. So
    rows are written once, with their number. Other rows than were counted are an error.
    """
    spark = df.sparkSession
    with fixed_splits(spark):
        counted = with_block(df).groupBy("_path", "_start").agg(F.count("*").alias("_rows"))
        blocks, on, total = numbered_blocks(counted, limits)
        # The lower 33 bits of the id count the rows of a task, which is one block.
        place = (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("_place")
        rows = with_block(df).select("*", block_key(), place).join(blocks, on)
        numbered = rows.select((F.col("_place") + F.col("_before")).alias(name), *[f"`{c}`" for c in df.columns])
        return write_numbered(numbered, name, total, write)


def ingest_events(
    spark: SparkSession,
    path: str,
    limits: Limits = LIMITS,
    multi_line: bool = False,
    write: Write = lambda df: keep(df, "file-rows"),
) -> DataFrame:
    """The rows of CSV files in file order, written once by `write`. `multi_line` allows line breaks inside quotes."""
    if multi_line:
        from pressure.sources.quoted_csv import ingest_quoted

        return ingest_quoted(spark, path, limits, write)
    return with_file_order(read_csv(spark, path), limits=limits, write=write)
