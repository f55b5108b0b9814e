"""CSV files with line breaks inside quotes, read by many tasks.

Where a record ends depends on all quotes before it, so a block of a file does not know by itself which
of its lines begin a record. It does know both answers: whether its number of quotes is odd, and how many lines begin a
record if it is entered outside quotes, and if it is entered inside. The states of all blocks follow from
those in one pass over the table of blocks. Then every block is cut on its own; a record that runs over the end of its
block is put together from its pieces, at most two a block.

A quote inside a quoted value is doubled, which leaves the count even. Lines end in \\n or \\r\\n. Blank lines between
records are skipped. The header is one line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressure.config import LIMITS, Limits
from pressure.sources.csv_log import Write, block_key, file_schema, fixed_splits, numbered_blocks, with_block, write_numbered
from pressure.sources.scratch import keep

_BLOCK = "_path string, _start long, _odd boolean, _outside long, _inside long, _header string"
# What a task reads at most if there are more tasks than a shuffle has; the size of Spark's own file splits.
_TASK_BYTES = 128 << 20
_PIECE = "event_id long, _nth long, _whole boolean, text string"


def _states(lines: pa.Array, state: int) -> np.ndarray:
    """Whether each line begins outside (0) or inside quotes (1), and at last what follows the last one."""
    quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
    return (np.concatenate([[0], np.cumsum(quotes)]) + state) % 2


def _blank(lines: pa.Array) -> np.ndarray:
    return pc.equal(pc.utf8_trim_whitespace(lines), "").to_numpy(zero_copy_only=False)


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """The rows of a task cut where a block ends, and whether a block begins with them. A task reads its blocks one by one."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        paths, starts = batch["_path"], batch["_start"].to_numpy(zero_copy_only=False)
        other = pc.not_equal(paths[1:], paths[:-1]).to_numpy(zero_copy_only=False) | (starts[1:] != starts[:-1])
        cuts = [0, *(np.flatnonzero(other) + 1), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            block = (paths[begin].as_py(), int(starts[begin]))
            yield block != last, batch.slice(begin, end - begin)
            last = block


def _count_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: its parity, and the records that begin in it for both states it may be entered in."""
    schema = pa.schema([
        ("_path", pa.string()), ("_start", pa.int64()), ("_odd", pa.bool_()), ("_outside", pa.int64()), ("_inside", pa.int64()), ("_header", pa.string()),
    ])
    rows: list[dict] = []
    for begins_block, batch in _by_block(batches):
        lines = batch["value"]
        if begins_block:
            start = batch["_start"][0].as_py()
            header = lines[0].as_py().rstrip("\r") if start == 0 else None
            rows.append({"_path": batch["_path"][0].as_py(), "_start": start, "_odd": False, "_outside": -(start == 0), "_inside": 0, "_header": header})
        block = rows[-1]
        states = _states(lines, int(block["_odd"]))
        begins = states[:-1]
        filled = ~_blank(lines)
        for entered, name in enumerate(("_outside", "_inside")):
            block[name] += int(((begins == entered) & filled).sum())
        block["_odd"] = bool(states[-1])
    yield pa.RecordBatch.from_pylist(rows, schema)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each block, numbered; what belongs to an earlier one, or goes on in the next, as a piece."""
    schema = pa.schema([("event_id", pa.int64()), ("_nth", pa.int64()), ("_whole", pa.bool_()), ("text", pa.string())])
    state = number = start = None
    pending: list[str] = []  # lines of the record that has begun
    begun = skip = False

    def left() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"event_id": [number], "_nth": [start], "_whole": [False], "text": ["\n".join(pending)]}, schema)

    for begins_block, batch in _by_block(batches):
        lines = batch["value"]
        if begins_block:
            if pending:
                yield left()
            pending, begun = [], False
            state, number, start = int(batch["_entered"][0].as_py()), batch["_before"][0].as_py(), batch["_start"][0].as_py()
            skip = start == 0  # the header
        states = _states(lines, state)
        found: dict[str, list] = {n: [] for n in schema.names}
        blank = _blank(lines)
        for i, line in enumerate(lines.to_pylist()):
            if states[i] == 0 and not pending:
                if skip or blank[i]:
                    skip = False
                    continue
                begun, number = True, number + 1
            pending.append(line)
            if states[i + 1] == 0:
                for n, v in zip(schema.names, (number, start, begun, "\n".join(pending).removesuffix("\r")), strict=True):
                    found[n].append(v)
                pending, begun = [], False
        state = int(states[-1])
        yield pa.RecordBatch.from_pydict(found, schema)
    if pending:
        yield left()


def _task_count(spark: SparkSession, path: str) -> int:
    """Tasks to read the blocks of all files by: those of a shuffle, more where one would read more than `_TASK_BYTES`.

    Blocks may be small, and every task reports to the driver.
    """
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // _TASK_BYTES))


def ingest_quoted(spark: SparkSession, path: str, limits: Limits, write: Write) -> DataFrame:
    """The rows of all files in file order with their number, parsed by name and type, written once."""
    schema = file_schema(spark, path, multi_line=True)
    tasks = _task_count(spark, path)
    with fixed_splits(spark):
        # Neighbouring blocks share a task, which reads each from top to bottom.
        lines = with_block(spark.read.option("lineSep", "\n").text(path)).coalesce(tasks)
        blocks = lines.mapInArrow(_count_blocks, _BLOCK)
        earlier = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
        odd = F.coalesce(F.count_if("_odd").over(earlier), F.lit(0)) % 2 == 1
        entered = blocks.withColumn("_entered", odd)
        entered = entered.withColumn("_rows", F.when(F.col("_entered"), F.col("_inside")).otherwise(F.col("_outside")))
        entered = keep(entered, "entered-blocks")
        ends = F.max_by(F.col("_entered") != F.col("_odd"), "_start").alias("_open")
        placed, on, total = numbered_blocks(entered.select("_path", "_start", "_rows", "_entered"), limits)
        _check(spark, path, entered.groupBy("_path").agg(ends, F.max("_header").alias("_header")))
        # Lines must stay in order, so the table of blocks is broadcast: one short row for each 128 MB or so.
        cut = lines.select("*", block_key()).join(F.broadcast(placed), on)
        pieces = cut.select("value", "_path", "_start", "_entered", "_before").mapInArrow(_cut, _PIECE)
        return _parsed(pieces, schema, total, write)


def _check(spark: SparkSession, path: str, files: DataFrame) -> None:
    """Every file has the same header and closes its quotes."""
    wrong = files.agg(F.count_distinct("_header").alias("headers"), F.max("_open").alias("open")).first()
    if wrong["headers"] > 1:
        raise ValueError(f"the files of {path} differ in their headers")
    if wrong["open"]:
        raise ValueError(f"a file of {path} ends inside quotes")


def _parsed(pieces: DataFrame, schema: T.StructType, total: int, write: Write) -> DataFrame:
    whole = pieces.where("_whole").select("event_id", "text")
    # The pieces of one record have its number; they are few, and in order of their blocks.
    parts = F.array_sort(F.collect_list(F.struct("_nth", "text")))
    joined = pieces.where("NOT _whole").groupBy("event_id").agg(parts.alias("_parts"))
    records = whole.unionByName(joined.select("event_id", F.concat_ws("\n", "_parts.text").alias("text")))
    options = {"escape": '"', "mode": "FAILFAST", "multiLine": "true"}
    row = F.from_csv("text", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), options)
    rows = records.select("event_id", row.alias("_row")).select("event_id", "_row.*")
    return write_numbered(rows, "event_id", total, write)

