from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pressure.llm import packing


def brute(cell: list[dict], capacity: int) -> list[int]:
    """The same packing by looking at every bin for every piece; the rows are in packing order."""
    bins: list[dict] = []
    chosen = []
    for row in cell:
        fits = [
            (b["left"], i) for i, b in enumerate(bins)
            if b["left"] >= row["size"] and (row["source"] is None or row["source"] not in b["sources"])
            and (row["cluster"] is None or row["cluster"] not in b["clusters"])
        ]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append({"left": capacity, "sources": set(), "clusters": set()})
        bins[i]["left"] -= row["size"]
        bins[i]["sources"].add(row["source"])
        bins[i]["clusters"].add(row["cluster"])
        chosen.append(i)
    return chosen


@pytest.mark.parametrize("seed", range(6))
def test_each_piece_goes_to_the_tightest_compatible_bin(seed):
    rng = random.Random(seed)
    rows = [
        {
            "id": i, "piece": 0, "size": rng.choice([0, 1, 50, 100, rng.randint(1, 100)]), "cell": 0, "start": 0,
            "source": rng.choice([None, "hot", "hot", *(f"s{j}" for j in range(80))]), "cluster": rng.choice([None, "c", *(f"k{j}" for j in range(150))]),
        }
        for i in range(400)
    ]
    schema = pa.schema([("id", pa.int64()), ("piece", pa.int32()), ("size", pa.int64()), ("cell", pa.int64()), ("start", pa.int64()), ("source", pa.string()), ("cluster", pa.string())])
    packed = packing.pack_cell(pa.Table.from_pylist(rows, schema), 100).to_pylist()
    assert [r["size"] for r in packed] == sorted((r["size"] for r in rows), reverse=True)
    assert [r["bin"] for r in packed] == brute(packed, 100)


def check(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r["bin"], []).append(r)
    for members in bins.values():
        assert sum(r["size"] for r in members) == members[0]["bin_size"] <= capacity
        assert sorted(r["place"] for r in members) == list(range(len(members)))
        for key in ("source", "cluster"):
            known = [r[key] for r in members if r[key] is not None]
            assert len(known) == len(set(known))


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.pack_documents(docs).collect()
    check(rows, packing.CAPACITY)
    size = {}
    for r in rows:
        size[r["doc_id"]] = size.get(r["doc_id"], 0) + r["size"]
    assert size == {r["doc_id"]: len((r["text"] or "").encode()) for r in docs.collect()}


def test_a_hot_source_and_a_hot_cluster(spark):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.lit("same words").alias("text"), (F.col("id") % 3).cast("string").alias("source"))
    rows = packing.pack(docs, F.lit(10), F.col("source"), F.when(F.col("doc_id") < 300, F.lit("c")), capacity=100, cell_pieces=100).collect()
    check(rows, 100)
    assert len(rows) == 900


def test_odd_rows(odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs, 64).collect()
    check(rows, 64)
    assert sum(r["size"] for r in rows) == sum(len((r["text"] or "").encode()) for r in odd_docs.collect())
    assert packing.pack_documents(no_docs).collect() == []


def test_repeated_rows_are_spread_over_the_cells(spark):
    docs = spark.range(6000).selectExpr("7L as doc_id", "'the same text' as text", "'s' as source")
    rows = packing.pack(docs, F.lit(10), F.lit(None).cast("string"), F.lit(None).cast("string"), capacity=100, cell_pieces=100).collect()
    check(rows, 100)
    cells = {}
    for r in rows:
        cell = r["bin"] >> packing.BIN_BITS
        cells[cell] = cells.get(cell, 0) + 1
    assert len(cells) > 50 and max(cells.values()) < 200
