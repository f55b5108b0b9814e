"""Labelled texts that a model is fitted on: a bounded sample, fitted in one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressure.llm.common import held_out

# Labelled rows of each grade that a model is fitted on at most.
ROWS_PER_GRADE = 2000

_SCHEMA = pa.schema([("id", pa.string()), ("text", pa.string()), ("grade", pa.int32())])


def sample(docs: DataFrame, labels: DataFrame, grade: str, grades: list[int], rows_per_grade: int = ROWS_PER_GRADE) -> DataFrame:
    """(id, text, grade): whole texts of up to so many labelled documents of each grade, chosen by hash.

    Held-out rows and rows without an id or a known grade take no part; of several labels of a document
    the highest counts, and of several texts of an id the smallest. At most rows_per_grade rows of each
    grade are chosen, so the chosen ids are broadcast.
    """
    rated = (
        labels.where(F.col("doc_id").isNotNull() & F.col(grade).isin(grades) & ~held_out("doc_id"))
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.max(grade).cast("int").alias("grade"))
    )
    known = docs.select(F.col("doc_id").alias("id")).where(F.col("id").isNotNull())
    rated = rated.join(known, "id", "left_semi")
    parts = [rated.where(F.col("grade") == g).orderBy(F.xxhash64("id"), "id").limit(rows_per_grade) for g in grades]
    chosen = reduce(DataFrame.unionAll, parts)
    texts = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "id").groupBy("id", "grade").agg(F.min("text").alias("text"))


def fit(rows: DataFrame, train: Callable[[list[str], list[int]], bytes]) -> bytes:
    """Runs `train` on the sample in one task, in order of id; its result goes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches([b.cast(_SCHEMA) for b in batches], _SCHEMA).sort_by("id")
        yield pa.RecordBatch.from_pydict({"model": [train(table["text"].to_pylist(), table["grade"].to_pylist())]})

    one = rows.select(F.col("id").cast("string"), "text", "grade").repartition(1)
    made = one.mapInArrow(run, "model binary").first()
    return bytes(made["model"]) if made else train([], [])  # no task runs over a table known to be empty
