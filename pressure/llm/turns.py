"""Turns of conversations in order: a place for every turn, however long a conversation is.

Turns are ordered by their number, unknown ones first; ties by role, then by the first TIE_CHARS
characters of the text, then by its SHA-256. Rows alike in all of that are equal, and their order does not show.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressure.sources.scratch import keep

TIE_CHARS = 48

# Bits of a place that count inside a partition; the bits above them are its number.
_INSIDE = 33


def conversation_rows(conversations: DataFrame, absent: str) -> DataFrame:
    """(conv_id, turn, role, text) with `absent` in place of null roles and texts; all other columns go."""
    return conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(absent)).alias(c) for c in ("role", "text")],
    )


def turn_order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.left("text", F.lit(TIE_CHARS)), F.sha2("text", 256)]


def numbered(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """(conv_id, pos, values): the place of every turn in its conversation, from 1.

    All turns are sorted into ranges by conversation and order, so a conversation with a third of all
    rows lies in many ranges and equal rows are spread by a number of their own. Texts stay where they
    are: the ranges hold a digest. Each range counts its conversations on its own; only its
    first one can have begun before, and a table with one row a range says how far.
    """
    sort = {
        "_turn": F.col("turn"), "_role": F.col("role"), "_head": F.left("text", F.lit(TIE_CHARS)),
        "_digest": F.sha2("text", 256), "_own": F.monotonically_increasing_id(),
    }
    narrow = rows.select("conv_id", *[c.alias(n) for n, c in sort.items()], *[c.alias(n) for n, c in values.items()])
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", *sort)]
    sorted_rows = narrow.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", *values)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = (), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0)
            filled = ids.fill_null(0).to_numpy(zero_copy_only=False)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            new = np.ones(len(filled), bool)
            new[1:] = (filled[1:] != filled[:-1]) | (known[1:] != known[:-1])
            first = (int(filled[0]), bool(known[0]))
            at = np.arange(len(filled))
            nth = at - np.maximum.accumulate(np.where(new, at, 0)) + 1
            if first == last:
                upto = int(np.argmax(new[1:])) + 1 if new[1:].any() else len(new)
                nth[:upto] += held
            last, held = (int(filled[-1]), bool(known[-1])), int(nth[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nth.astype(np.int64))], [*batch.schema.names, "_nth"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sorted_rows.schema.fields)
    placed = keep(
        sorted_rows.mapInArrow(count, f"{schema}, _nth long").withColumn("_place", F.monotonically_increasing_id()), "turns"
    ).withColumn("_range", F.shiftright("_place", _INSIDE))
    ranges = placed.groupBy("_range").agg(
        F.min_by("conv_id", "_place").alias("_first"), F.max_by("conv_id", "_place").alias("_last"), F.max_by("_nth", "_place").alias("_rows")
    )
    # One row a range from here on.
    so_far = ranges.withColumn("_upto", F.sum("_rows").over(Window.partitionBy("_last").orderBy("_range")))
    by_range = Window.orderBy("_range")
    goes_on = F.lag("_last").over(by_range).eqNullSafe(F.col("_first")) & F.lag("_range").over(by_range).isNotNull()
    before = so_far.select("_range", "_first", F.when(goes_on, F.lag("_upto").over(by_range)).otherwise(0).alias("_before"))
    shift = F.when(F.col("conv_id").eqNullSafe(F.col("_first")), F.col("_before")).otherwise(0)
    return placed.join(F.broadcast(before), "_range").select("conv_id", (F.col("_nth") + shift).alias("pos"), *values)
