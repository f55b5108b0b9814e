"""Approximate nearest neighbours by stable projections and a kd-tree, largest inner product first.

Inner products become distances by one more component: a candidate x gets sqrt(M^2 - |x|^2), where M
is the largest norm, a query is scaled to length M and gets 0; the nearest candidate is then the one of largest
inner product. A few projections on normal directions keep distances up to a chi-square factor:
projected^2 / true^2 has as many degrees of freedom as there are projections. So a query reads
candidates in order of projected distance, leaf by leaf of a kd-tree, verifies their inner products,
and stops as soon as the next projected distance would, with probability CONFIDENCE, not belong to
a candidate nearer than the worst of its best k.

On the cluster the top of the tree cuts the candidates into cells; a query first searches its own
cell and then those other cells that its test has not ruled out. The cuts are fitted on a sample of at most
SAMPLE vectors, and every vector is indexed. Cells are dealt out by hash into parts of bounded size, queries of a
cell into blocks, so neither a crowd of like vectors nor one of like queries lands in one task. Of
equal vectors, those with the k + 1 smallest ids are candidates; others could not be among the k
nearest of any query.

Vectors that are null, empty, zero or hold a null or non-finite component, and rows without an id,
take no part. Rows that repeat both id and vector count once. Of several rows with the id of a query the smallest vector asks; a query is no candidate of its own
id. Only vectors as long as the query's are its candidates. Ties go to the smaller id. An empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressure.llm.common import shared
from pressure.llm.vectors import by_length, matrix, read_vectors
from pressure.sources.scratch import keep

PROJECTIONS = 8
CONFIDENCE = 0.97
SAMPLE = 32768
# Candidates a part of a cell holds about, and cells at most; a broadcast tree has no more nodes than cells.
PART, CELLS = 8192, 65536
LEAF = 256
QUERY_BLOCK = 2048


def chi_square_quantile(p: float, degrees: int) -> float:
    """For an even number of degrees."""

    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(degrees // 2))

    low, high = 0.0, 1.0
    while below(high) < p:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


def directions(length: int) -> np.ndarray:
    return np.random.default_rng((length, 6)).normal(size=(length + 1, PROJECTIONS))


def projected_candidates(vectors: np.ndarray, most: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(most * most - np.einsum("nd,nd->n", vectors, vectors), 0))
    return np.concatenate([vectors, rest[:, None]], 1) @ directions(vectors.shape[1])


def projected_queries(vectors: np.ndarray, most: float) -> np.ndarray:
    return (vectors * (most / np.linalg.norm(vectors, axis=1))[:, None]) @ directions(vectors.shape[1])[:-1]


class Tree:
    """kd-tree over projected points: rows in leaf order, where leaves begin, and the box of each."""

    def __init__(self, points: np.ndarray, leaf: int):
        parts = [np.arange(len(points))]
        while max(map(len, parts)) > leaf:
            halves = []
            for rows in parts:
                if len(rows) <= leaf:
                    halves.append(rows)
                    continue
                axis = int(np.ptp(points[rows], axis=0).argmax())
                order = np.argpartition(points[rows, axis], len(rows) // 2)
                halves += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
            parts = halves
        self.leaves = parts
        self.low = np.array([points[rows].min(0) for rows in parts])
        self.high = np.array([points[rows].max(0) for rows in parts])


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every box."""
    out = np.zeros((len(points), len(low)))
    for axis in range(points.shape[1]):
        x = points[:, axis, None]
        gap = np.maximum(np.maximum(low[None, :, axis] - x, x - high[None, :, axis]), 0)
        out += gap * gap
    return out


class Search:
    """The k best candidates of each query so far: scores and rows, worst last."""

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, bound: np.ndarray, k: int, most: float):
        self.queries, self.ids, self.k = queries, query_ids, k
        self.length = np.linalg.norm(queries, axis=1)
        self.most = most
        self.bound = bound  # a score that k candidates are known to reach
        self.score = np.full((len(queries), k), -np.inf)
        self.row = np.full((len(queries), k), -1, np.int64)

    def reach(self, q: np.ndarray | slice) -> np.ndarray:
        """Squared projected distance beyond which the test rules candidates out."""
        worst = np.maximum(self.score[q, -1], self.bound[q])
        true = 2 * self.most * (self.most - worst / self.length[q])
        return np.where(np.isfinite(worst), np.maximum(true, 0) * QUANTILE, np.inf)

    def run(self, points: np.ndarray, vectors: np.ndarray, ids: np.ndarray, projected: np.ndarray) -> None:
        tree = Tree(points, LEAF)
        distance = box_distances(projected, tree.low, tree.high)
        nearest = np.argsort(distance, axis=1, kind="stable")
        every = np.arange(len(self.queries))
        going = every
        for step in range(len(tree.leaves)):
            leaf = nearest[going, step]
            inside = distance[going, leaf] <= self.reach(going)
            going, leaf = going[inside], leaf[inside]
            if not len(going):
                break
            for each in np.unique(leaf).tolist():
                self.verify(going[leaf == each], tree.leaves[each], vectors, ids)

    def verify(self, q: np.ndarray, rows: np.ndarray, vectors: np.ndarray, ids: np.ndarray) -> None:
        # Each product is summed in the same order wherever it stands, so equal vectors tie exactly.
        score = np.einsum("qd,pd->qp", self.queries[q], vectors[rows])
        score[self.ids[q][:, None] == ids[rows][None, :]] = -np.inf
        better = (score >= np.maximum(self.score[q, -1], self.bound[q])[:, None]).any(1)
        if not better.any():
            return
        q, score = q[better], score[better]
        every_score = np.concatenate([self.score[q], score], 1)
        every_row = np.concatenate([self.row[q], np.broadcast_to(rows, score.shape)], 1)
        tie = np.where(every_row < 0, np.iinfo(np.int64).max, ids[every_row])
        order = np.lexsort((tie, -every_score), axis=1)[:, : self.k]
        self.score[q] = np.take_along_axis(every_score, order, 1)
        self.row[q] = np.take_along_axis(every_row, order, 1)


QUANTILE = chi_square_quantile(CONFIDENCE, PROJECTIONS)


def cuts(sample: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """(axis, value) of the inner nodes of a complete tree, root first, that halves the sample again and again."""
    depth = max(0, math.ceil(math.log2(max(1, cells))))
    axis, value = np.zeros(2**depth, np.int64), np.zeros(2**depth)
    level = [np.arange(len(sample))]
    node = 1
    for _ in range(depth):
        below = []
        for rows in level:
            own = sample[rows]
            if len(rows):
                axis[node] = int(np.ptp(own, axis=0).argmax())
                value[node] = np.median(own[:, axis[node]])
            left = own[:, axis[node]] < value[node]
            below += [rows[left], rows[~left]]
            node += 1
        level = below
    return axis, value


def cell_of(points: np.ndarray, tree: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    axis, value = tree
    node = np.ones(len(points), np.int64)
    for _ in range(int(math.log2(len(axis)))):
        node = 2 * node + (points[np.arange(len(points)), axis[node]] >= value[node])
    return node - len(axis)


def cell_boxes(tree: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    axis, value = tree
    low, high = np.full((2 * len(axis), PROJECTIONS), -np.inf), np.full((2 * len(axis), PROJECTIONS), np.inf)
    for node in range(1, len(axis)):
        for child, bounds in ((2 * node, high), (2 * node + 1, low)):
            low[child], high[child] = low[node], high[node]
            bounds[child, axis[node]] = value[node]
    return low[len(axis) :], high[len(axis) :]


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for rows in by_length(batch.column("vector")):
        own = batch.take(pa.array(rows))
        yield own, matrix(own.column("vector"))


def _placed(table: DataFrame, sent, most: dict[int, float], queries: bool) -> DataFrame:
    """Rows with the cell they lie in."""
    kind = table.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, vectors in _matrices(batch):
                n = vectors.shape[1]
                points = (projected_queries if queries else projected_candidates)(vectors, most[n])
                cell = pa.array(cell_of(points, sent.value[n]))
                yield pa.RecordBatch.from_arrays([own.column("id"), own.column("vector"), cell], ["id", "vector", "cell"])

    return table.select("id", "vector").mapInArrow(run, f"id {kind}, vector array<double>, cell long")


def _routed(table: DataFrame, sent, most: dict[int, float]) -> DataFrame:
    """Queries (id, vector, bound, home) once for each other cell that the test does not rule out."""
    kind = table.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, vectors in _matrices(batch):
                n = vectors.shape[1]
                bound = own.column("bound").to_numpy(zero_copy_only=False)
                search = Search(vectors, np.zeros(len(own)), bound, 1, most[n])
                low, high = cell_boxes(sent.value[n])
                for a in range(0, len(own), 256):
                    part = slice(a, a + 256)
                    distance = box_distances(projected_queries(vectors[part], most[n]), low, high)
                    near = distance <= search.reach(part)[:, None]
                    near[np.arange(len(near)), own.column("home").to_numpy()[part]] = False
                    row, cell = np.nonzero(near)
                    picked = own.take(pa.array(row + a))
                    columns = [picked.column("id"), picked.column("vector"), pa.array(cell), picked.column("bound")]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "vector", "cell", "bound"])

    return table.select("id", "vector", "bound", "home").mapInArrow(run, f"id {kind}, vector array<double>, cell long, bound double")


def _searched(candidates: DataFrame, queries: DataFrame, k: int, most: dict[int, float]) -> DataFrame:
    """(query_id, vec_id, score): the k best of each query in each part of the cells it is sent to.

    candidates: (id, vector, cell, part, parts); queries: (id, vector, cell, bound).
    """
    kind = candidates.schema["id"].dataType.simpleString()
    per_cell = candidates.groupBy(F.size("vector").alias("length"), "cell").agg(F.max("parts").alias("parts"))
    asked = queries.withColumn("length", F.size("vector")).join(per_cell, ["length", "cell"])
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    counts = asked.groupBy("length", "cell").agg(F.ceil(F.count("*") / F.max("parts") / QUERY_BLOCK).cast("long").alias("blocks"))
    asked = asked.join(counts, ["length", "cell"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    held = candidates.withColumn("length", F.size("vector")).join(counts, ["length", "cell"])
    held = held.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    keys = ["length", "cell", "part", "block"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        empty = pa.table([pa.array([], right.schema.field("id").type), pa.array([], left.schema.field("id").type), pa.array([], pa.float64())], names)
        if not len(left) or not len(right):
            return empty
        vectors, queries = matrix(left["vector"]), matrix(right["vector"])
        n = vectors.shape[1]
        both = pa.concat_arrays([left["id"].combine_chunks(), right["id"].combine_chunks()])
        rank = both.dictionary_encode().indices.to_numpy() if not pa.types.is_integer(both.type) else both.to_numpy()
        ids, query_ids = rank[: len(left)].astype(np.int64), rank[len(left) :].astype(np.int64)
        search = Search(queries, query_ids, right["bound"].to_numpy(), k, most[n])
        search.run(projected_candidates(vectors, most[n]), vectors, ids, projected_queries(queries, most[n]))
        q, place = np.nonzero(np.isfinite(search.score))
        return pa.table(
            [right["id"].take(pa.array(q)), left["id"].take(pa.array(search.row[q, place])), pa.array(search.score[q, place])], names
        )

    groups = held.select(*keys, "id", "vector").groupBy(*keys)
    return groups.cogroup(asked.select(*keys, "id", "vector", "bound").groupBy(*keys)).applyInArrow(
        run, f"query_id {kind}, vec_id {kind}, score double"
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, is_query: Column, k: int, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of largest inner product found for each query.

    is_query: a condition on the id column that says which rows ask; all other rows are their candidates, and
    queries are candidates of each other.
    """
    picked = read_vectors(vectors.withColumn("__asks", F.coalesce(is_query, F.lit(False))), id_column, vector_column, "__asks")
    known = keep(picked.withColumnRenamed("__asks", "asks"), "vectors")
    length = F.size("vector")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    # One row for each length that occurs: at most a few.
    shapes = known.groupBy(length.alias("length")).agg(F.max(norm).alias("most"), F.count("*").alias("rows")).collect()
    most = {r["length"]: r["most"] * (1 + 1e-12) for r in shapes}
    trees = {}
    for r in shapes:
        own = known.where(length == r["length"]).orderBy(F.xxhash64("id"), "id", "vector").limit(SAMPLE).select("vector")
        sample = matrix(own.toArrow()["vector"])
        trees[r["length"]] = cuts(projected_candidates(sample, most[r["length"]]), min(CELLS, -(-r["rows"] // PART)))
    sent = shared(vectors.sparkSession, trees)

    same = Window.partitionBy("vector").orderBy("id")
    distinct = known.select("id", "vector").distinct().withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1)
    placed = keep(_placed(distinct, sent, most, False), "placed")
    sizes = placed.groupBy(F.size("vector").alias("length"), "cell").agg(F.ceil(F.count("*") / (1.5 * PART)).cast("long").alias("parts"))
    placed = placed.withColumn("length", F.size("vector")).join(sizes, ["length", "cell"]).drop("length")
    candidates = placed.withColumn("part", F.pmod(F.xxhash64("id", F.lit(6)), F.col("parts")))

    asking = known.where("asks").groupBy("id").agg(F.min("vector").alias("vector"))
    asking = keep(_placed(asking, sent, most, True), "queries")
    home = keep(_searched(candidates, asking.withColumn("bound", F.lit(float("-inf"))), k, most), "home")
    worst = _best(home, k).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("bound"))
    bounded = asking.withColumnRenamed("cell", "home").join(worst, "id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    away = _searched(candidates, _routed(bounded, sent, most), k, most)
    best = _best(home.unionAll(away).dropDuplicates(["query_id", "vec_id", "score"]), k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
