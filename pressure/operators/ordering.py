"""Running totals and row numbers over a whole table, without sending it through one task."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressure.config import LIMITS
from pressure.sources.scratch import keep, keep_counted

# No limit is so low that parts of this many rows are too much for a task.
_PART_ROWS = 100_000


def part_count(spark: SparkSession, rows: int, part_rows: int, most_rows: int) -> int:
    """Into how many tasks or files a table is cut: parts of `part_rows` rows, and of `most_rows` at most.

    There are no more parts than a shuffle has, unless these would hold more than `most_rows` rows. So limits of a few rows
    do not ask for a task and a file for every few rows of a large table.
    """
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(min(shuffled, ceil(rows / part_rows)), ceil(rows / max(most_rows, _PART_ROWS)), 1)


def running_total(
    df: DataFrame,
    order: Sequence[str],
    name: str,
    weight: Column | None = None,
    one_task_rows: int = LIMITS.one_task_rows,
) -> DataFrame:
    """Adds `name`, the sum of `weight` over all rows up to this one; `order` must be unique.

    A small table takes one sorted window. A larger one is cut into sorted ranges (`part_count`); each range
    sums on its own and adds the total of the ranges before it. The ranges are written before
    they are used twice, because sampling could place their borders differently next time.
    """
    weight = F.lit(1) if weight is None else weight
    sort = [F.col(c).asc_nulls_last() for c in order]
    rows, count = keep_counted(df, "ordered")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    if count <= one_task_rows:
        return rows.withColumn(
            name, F.sum(weight).over(Window.orderBy(*sort).rowsBetween(*so_far)).cast("long")
        )
    ranges = part_count(df.sparkSession, count, one_task_rows, one_task_rows)
    ranged = keep(
        rows.repartitionByRange(ranges, *sort).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    before = (
        ranged.groupBy("_range")
        .agg(F.sum(weight).alias("_sum"))
        .select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = F.sum(weight).over(Window.partitionBy("_range").orderBy(*sort).rowsBetween(*so_far))
    return (
        ranged.withColumn("_inside", inside)
        .join(F.broadcast(before), "_range")
        .withColumn(name, (F.col("_inside") + F.col("_before")).cast("long"))
        .drop("_range", "_inside", "_before")
    )


def row_numbers(
    df: DataFrame, order: Sequence[str], name: str, one_task_rows: int = LIMITS.one_task_rows
) -> DataFrame:
    """Adds `name`, numbering the rows 1, 2, 3 ... in `order`, unknown values last."""
    return running_total(df, order, name, one_task_rows=one_task_rows)
