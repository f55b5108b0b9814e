"""Conflict-constrained best-fit packing of documents into sequences of fixed capacity.

A text longer than the capacity is cut into full pieces and a rest; nothing is dropped. Pieces are
dealt by hash into cells of bounded size, about as many as the input needs, and every cell is
packed by itself, largest piece first. The bins of a cell are kept in order of what they have
left, and carry a bitmap of the sources and duplicate clusters they hold. A piece goes to the first bin, from
its own size upwards, whose bitmap has neither its source nor its cluster: the tightest compatible
one. If there is none it opens a bin.

Two pieces of one source, or of one cluster, never share a bin. A null source or cluster conflicts
with nothing. Empty and null texts are pieces of size 0. Equal sizes are packed in order of id,
then piece. Repeated rows are pieces of their own. An empty table gives an empty result. Columns
other than those named are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressure.sources.scratch import keep_counted

CAPACITY = 8192
# Pieces a cell has on average.
CELL_PIECES = 2048
BIN_BITS = 20


class Bins:
    """Bins in order of what they have left."""

    def __init__(self, most: int, words: int):
        self.keys = np.empty(most, np.int64)  # room left << BIN_BITS | bin, ascending
        self.open = 0
        self.made = 0
        self.bits = np.zeros((most, words), np.uint64)

    def tightest(self, size: int, marks: list[tuple[int, np.uint64]]) -> int:
        """Place among the keys of the tightest compatible bin, or -1."""
        at = int(np.searchsorted(self.keys[: self.open], size << BIN_BITS))
        block = 16
        while at < self.open:
            bins = self.keys[at : min(at + block, self.open)] & ((1 << BIN_BITS) - 1)
            free = np.ones(len(bins), bool)
            for word, bit in marks:
                free &= (self.bits[bins, word] & bit) == 0
            if free.any():
                return at + int(free.argmax())
            at += block
            block *= 2
        return -1

    def put(self, size: int, capacity: int, marks: list[tuple[int, np.uint64]]) -> int:
        at = self.tightest(size, marks)
        if at < 0:
            left, chosen = capacity, self.made
            self.made += 1
        else:
            left, chosen = int(self.keys[at]) >> BIN_BITS, int(self.keys[at]) & ((1 << BIN_BITS) - 1)
            self.keys[at : self.open - 1] = self.keys[at + 1 : self.open]
            self.open -= 1
        for word, bit in marks:
            self.bits[chosen, word] |= bit
        key = ((left - size) << BIN_BITS) | chosen
        at = int(np.searchsorted(self.keys[: self.open], key))
        self.keys[at + 1 : self.open + 1] = self.keys[at : self.open]
        self.keys[at] = key
        self.open += 1
        return chosen


def _marks(values: list, first_bit: int) -> tuple[list[tuple[int, np.uint64] | None], int]:
    """Bits for the values that occur more than once; the others cannot conflict."""
    bit = {v: first_bit + i for i, v in enumerate(sorted(v for v, n in Counter(values).items() if n > 1 and v is not None))}
    marks = {v: (b >> 6, np.uint64(1 << (b & 63))) for v, b in bit.items()}
    return [marks.get(v) for v in values], first_bit + len(bit)


def pack_cell(cell: pa.Table, capacity: int) -> pa.Table:
    """The pieces of a cell in the order in which they are packed, with the bin's number, the place in it and what it holds."""
    order = [("size", "descending"), *((c, "ascending") for c in ("id", "piece", "cluster", "source"))]
    cell = cell.sort_by(order)
    sources, bits = _marks(cell["source"].to_pylist(), 0)
    clusters, bits = _marks(cell["cluster"].to_pylist(), bits)
    sizes = cell["size"].to_numpy()
    bins = Bins(len(cell), max(1, -(-bits // 64)))
    chosen, place = np.empty(len(cell), np.int64), np.empty(len(cell), np.int32)
    in_bin: Counter = Counter()
    for i, (size, *marks) in enumerate(zip(sizes.tolist(), sources, clusters, strict=True)):
        chosen[i] = bins.put(size, capacity, [m for m in marks if m])
        place[i] = in_bin[chosen[i]]
        in_bin[chosen[i]] += 1
    held = np.zeros(bins.made, np.int64)
    np.add.at(held, chosen, sizes)
    made = {"bin": pa.array(chosen), "place": pa.array(place), "bin_size": pa.array(held[chosen])}
    for name, column in made.items():
        cell = cell.append_column(name, column)
    return cell


def pieces(docs: DataFrame, size: Column, capacity: int) -> DataFrame:
    """A row per piece: number, start and size of the piece, in the unit of `size`."""
    count = F.greatest(F.ceil(F.col("__size") / capacity), F.lit(1)).cast("int")
    return (
        docs.withColumn("__size", size.cast("long"))
        .withColumn("piece", F.explode(F.sequence(F.lit(0), count - 1)))
        .withColumn("start", F.col("piece").cast("long") * capacity)
        .withColumn("size", F.least(F.col("__size") - F.col("start"), F.lit(capacity)).cast("long"))
        .drop("__size")
    )


def pack(
    docs: DataFrame,
    size: Column,
    source: Column,
    cluster: Column,
    id_column: str = "doc_id",
    capacity: int = CAPACITY,
    cell_pieces: int = CELL_PIECES,
) -> DataFrame:
    """(id, piece, start, size, source, cluster, bin, place, bin_size): every piece of every document in a bin.

    Sizes and starts count in the unit of `size`; bins are numbered over all cells.
    """
    named = docs.select(
        F.col(id_column).alias("id"), source.cast("string").alias("source"), cluster.cast("string").alias("cluster"), size.alias("__of"),
        F.monotonically_increasing_id().alias("__row"),
    )
    cut, count = keep_counted(pieces(named, F.coalesce(F.col("__of"), F.lit(0)), capacity).drop("__of"), "pieces")
    cells = max(1, -(-count // cell_pieces))
    # The number of the row, written with the piece, spreads repeated rows as well.
    celled = cut.withColumn("cell", F.pmod(F.xxhash64("__row", "id", "piece", "cluster"), F.lit(cells)).cast("long")).drop("__row")
    id_type = docs.schema[id_column].dataType.simpleString()
    schema = f"id {id_type}, piece int, start long, size long, source string, cluster string, bin long, place int, bin_size long"

    def run(cell: pa.Table) -> pa.Table:
        packed = pack_cell(cell, capacity)
        bins = pc.add(pc.multiply(packed["cell"], 1 << BIN_BITS), packed["bin"])
        packed = packed.set_column(packed.column_names.index("bin"), "bin", bins)
        return packed.select(["id", "piece", "start", "size", "source", "cluster", "bin", "place", "bin_size"])

    packed = celled.groupBy("cell").applyInArrow(run, schema)
    return packed.withColumnRenamed("id", id_column) if id_column != "id" else packed


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Documents with doc_id, text and source in sequences of `capacity` UTF-8 bytes; equal texts are a cluster."""
    text = F.col("text").cast("string").cast("binary")
    size = F.coalesce(F.octet_length(text), F.lit(0))
    cluster = F.when(size > 0, F.md5(text))
    return pack(docs, size, F.col("source"), cluster, capacity=capacity)
