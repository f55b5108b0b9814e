"""Near-duplicate embeddings by spherical-cap filters.

A code cuts the (rotated) space into blocks and has a few random directions in each; a filter is a
choice of one direction per block, and a vector belongs to all filters whose direction it exceeds by
the cap's height, found block by block without listing the others, and always to those within
the margin of its best. Blocks, directions and cap follow the number of components, so that a vector of any
length belongs to some tens of filters. Vectors of one label that share a filter are compared; the pairs that pass span
components. Inside a component all pairs are then compared, in blocks of bounded size, and links
are counted per vector, never written out.

Equal vectors of a label are one class from the start, so copies are not compared with each other.
A component larger than a block is dealt out in pairs of blocks, each a task of its own.

Vectors that are null, empty, zero or hold a null or non-finite component, and rows with a null
label or id, link with nothing. Vectors of different length do not link. Rows that share an id are
one node: their links add up. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressure.llm.components import components
from pressure.llm.minhash import _Forest, _found, _run_starts, _runs
from pressure.llm.vectors import by_length, matrix, read_vectors
from pressure.sources.scratch import keep

SIMILAR = 0.98
CODES = 2
# A vector belongs to the filters that it exceeds by the cap, and to those within the margin of its best. The cap is the
# lowest, in steps of 0.01, with no more than this many filters a vector and code on average, on PROBES random vectors.
WANTED, PROBES = 20, 200
MARGIN = 0.03
# Cosines this close to the threshold are worked out again, summed without error.
UNSURE = 1e-9
BLOCK_MEMBERS = 1024
# Vectors decoded at one time.
DECODED = 512


def shape(length: int) -> tuple[int, int]:
    """(blocks, directions of each): a short vector has too little in a block for four of them."""
    return (1, 2) if length == 1 else (1, 256) if length < 16 else (2, 64) if length < 32 else (4, 32)


@lru_cache(8)
def code(length: int, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(rotation, directions by block) for vectors of this length; blocks of a padded length are equal."""
    blocks, several = shape(length)
    width = -(-length // blocks)
    rng = np.random.default_rng((length, number))
    rotation = np.linalg.qr(rng.normal(size=(width * blocks, width * blocks)))[0][:length]
    directions = rng.normal(size=(blocks, several, width))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True) * np.sqrt(blocks)
    return rotation, directions


@lru_cache(64)
def cap(length: int) -> tuple[float, float]:
    """(cap, margin) for vectors of this length; cosines of long random vectors are small, so their margin is."""
    margin = MARGIN * min(1.0, 8 / length**0.5) if length > 2 else 0.0
    probes = _unit(np.random.default_rng((length, CODES)).normal(size=(PROBES, length)))
    height = 100
    while height > -100 and len(_decode(probes, 0, (height - 1) / 100, margin)[0]) <= WANTED * PROBES:
        height -= 1
    return height / 100, margin


def _decode(vectors: np.ndarray, number: int, height: float, margin: float) -> tuple[np.ndarray, np.ndarray]:
    rotation, directions = code(vectors.shape[1], number)
    blocks, several, _ = directions.shape
    turned = (vectors @ rotation).reshape(len(vectors), blocks, -1)
    score = np.einsum("nbw,bdw->nbd", turned, directions)
    best = score.max(2)
    short = best[:, :, None] - score  # what a direction falls short of the block's best
    allowed = np.maximum(best.sum(1) - height, margin)
    row, found, used = np.arange(len(vectors)), np.zeros(len(vectors), np.int64), np.zeros(len(vectors))
    for block in range(blocks):
        total = used[:, None] + short[row, block]
        which, direction = np.nonzero(total <= allowed[row][:, None])
        found = found[which] * several + direction
        used, row = total[which, direction], row[which]
    return row, found + number * several**blocks


def filters(vectors: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of every filter that a unit vector belongs to, rows ascending."""
    return _decode(vectors, number, *cap(vectors.shape[1]))


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)  # before squaring, so that nothing overflows
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _similar(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which unit vectors of two matrices (or stacks of them) are similar: the same answer for a pair wherever it stands."""
    score = one @ two.swapaxes(-1, -2)
    close = score >= SIMILAR
    for *stack, i, j in np.argwhere(np.abs(score - SIMILAR) < UNSURE).tolist():
        at = tuple(stack)
        close[(*at, i, j)] = math.fsum(one[(*at, i)] * two[(*at, j)]) >= SIMILAR
    return close


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, filters) of every vector; vectors of different length have different filters."""
    for batch in batches:
        for rows in by_length(batch.column("vector")):
            for a in range(0, len(rows), DECODED):
                own = batch.take(pa.array(rows[a : a + DECODED]))
                unit = _unit(matrix(own.column("vector")))
                parts = [filters(unit, number) for number in range(CODES)]
                row, found = (np.concatenate(x) for x in zip(*parts, strict=True))
                order = np.argsort(row, kind="stable")
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(own)))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(found[order] * 4096 + unit.shape[1] % 4096))
                yield pa.RecordBatch.from_arrays([own.column("id"), own.column("label"), lists], ["id", "label", "filters"])


def _spanning(close: np.ndarray) -> list[tuple[int, int]]:
    forest, pairs = _Forest(len(close)), []
    for i in range(1, len(close)):
        for j in np.flatnonzero(close[i, :i]).tolist():
            if forest.join(i, j):
                pairs.append((i, j))
    return pairs


def _close_in_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the close vectors of each bucket; buckets of one size are compared together."""
    for table in _runs(batches, 3):
        starts = _run_starts(table, 3)
        size = np.diff(np.append(starts, table.num_rows))
        column = table.column("vector").combine_chunks()
        length = np.diff(column.offsets.to_numpy())
        unit = np.zeros((table.num_rows, int(length.max())))
        for rows in by_length(column):
            unit[rows, : length[rows[0]]] = _unit(matrix(column.take(pa.array(rows))))
        label = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
        one, two = [], []
        for n in np.unique(size[size > 1]).tolist():
            at = starts[size == n]
            step = max(1, (1 << 20) // (n * n))
            for a in range(0, len(at), step):
                rows = at[a : a + step, None] + np.arange(n)
                close = _similar(unit[rows], unit[rows])
                close &= length[rows][:, :, None] == length[rows][:, None, :]
                close &= label[rows][:, :, None] == label[rows][:, None, :]
                close[:, np.arange(n), np.arange(n)] = False
                for k in np.flatnonzero(close.any((1, 2))).tolist():
                    for i, j in _spanning(close[k]):
                        one.append(rows[k, i])
                        two.append(rows[k, j])
        yield from _found(table.column("id"), np.array(one, np.int64), np.array(two, np.int64))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, links, near) of each member of a run: the rows that its links in this pair of blocks stand for, and the nearest."""
    for table in _runs(batches, 3):
        starts = _run_starts(table, 3).tolist()
        ids, links = [], []
        p, q, own = (table.column(c).to_numpy() for c in ("p", "q", "own"))
        weight, vectors = table.column("rows").to_numpy(), table.column("vector")
        for a, b in zip(starts, [*starts[1:], table.num_rows], strict=True):
            if b - a < 2:
                continue
            unit = _unit(matrix(vectors[a:b]))
            close = _similar(unit, unit)
            if p[a] == q[a]:
                np.fill_diagonal(close, False)
            else:
                close &= own[a:b, None] != own[None, a:b]
            ids.append(np.arange(a, b))
            links.append(close @ weight[a:b])
        if ids:
            kept, count = np.concatenate(ids), np.concatenate(links)
            some = count > 0
            column = table.column("id").combine_chunks().take(pa.array(kept[some]))
            yield pa.RecordBatch.from_arrays([column, pa.array(count[some])], ["id", "links"])


def _dealt(rows: DataFrame, key: str, blocks: str) -> DataFrame:
    return (
        rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col(blocks)))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)))
        .withColumn("p", F.least("own", "other"))
        .withColumn("q", F.greatest("own", "other"))
        .repartition(key, "p", "q")
        .sortWithinPartitions(key, "p", "q", "id")
    )


def near_duplicates(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) of every row: links are other rows of the label with cosine >= 0.98."""
    kind = vectors.schema[id_column].dataType.simpleString()
    label = F.col(label_column).alias("label")
    known = read_vectors(vectors.withColumn("label", label), id_column, vector_column, "label").where("label IS NOT NULL")
    known = keep(known, "vectors")
    label_kind = known.schema["label"].dataType.simpleString()
    classes = known.groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("rows"))
    classes = keep(classes, "classes")
    decoded = classes.select("id", "label", "vector").mapInArrow(_decoded, f"id {kind}, label {label_kind}, filters array<bigint>")
    buckets = decoded.select("id", "label", F.explode("filters").alias("filter"))
    buckets = buckets.select("id", "label", F.xxhash64("label", "filter").alias("bucket"))
    several = buckets.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    blocks = F.ceil(F.col("members") / BLOCK_MEMBERS).cast("long")
    met = buckets.join(several.select("bucket", blocks.alias("blocks")), "bucket")
    met = met.join(classes.select("id", "label", "vector"), ["id", "label"])
    pairs = _dealt(met, "bucket", "blocks").select("bucket", "p", "q", "id", "label", "vector")
    pairs = keep(pairs.mapInArrow(_close_in_runs, f"a {kind}, b {kind}"), "pairs")
    family = keep(components(pairs, "a", "b"), "families")
    members = classes.join(family, "id").select(F.struct("component", "label", F.size("vector")).alias("of"), "id", "rows", "vector")
    members = members.withColumn("family", F.xxhash64("of"))
    sizes = members.groupBy("family").agg(F.ceil(F.count("*") / BLOCK_MEMBERS).cast("long").alias("blocks"))
    dealt = _dealt(members.join(sizes, "family"), "family", "blocks").select("family", "p", "q", "id", "own", "rows", "vector")
    linked = dealt.mapInArrow(_counted, f"id {kind}, links long").groupBy("id").agg(F.sum("links").alias("links"))
    per_class = (
        classes.join(linked, "id", "left")
        .join(family, "id", "left")
        .select(
            "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")
        )
    )
    joined = known.select("id", "label", "vector").join(per_class, ["label", "vector"]).select("id", "n_links", "component_id")
    per_id = joined.groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    return (
        vectors.select(F.col(id_column).alias("id"))
        .join(per_id, "id", "left")
        .withColumn("component_id", F.coalesce("component_id", "id"))
        .select(
            F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "component_id",
            F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )
