from __future__ import annotations

import pytest

import corpus_pipeline
from pressure.llm import packing, quality, toxicity
from tests.llm.test_minhash import brute

SF = "/root/testdata/sf0.01"


def test_pipeline_matches_its_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    good = quality.Model.of_bytes(quality.fitted(docs, labels)).tails([r["text"] for r in rows.values()])[:, 0] >= quality.KEEP_FROM
    left = [r for r, keep in zip(rows.values(), good, strict=True) if keep]
    toxic = toxicity.Model.of_bytes(toxicity.fitted(docs, labels)).scores([r["text"] for r in left]) >= toxicity.THRESHOLD
    left = [r for r, gone in zip(left, toxic, strict=True) if not gone]
    roots = brute([(r["doc_id"], r["text"]) for r in left])
    left = {i for i, root in roots.items() if i == root}

    packed = corpus_pipeline.run(spark, SF).collect()
    size: dict = {}
    bins: dict = {}
    for r in packed:
        size[r["doc_id"]] = size.get(r["doc_id"], 0) + r["size"]
        bins.setdefault(r["bin"], []).append(r)
    assert size == {i: len(rows[i]["text"].encode()) for i in left}
    for members in bins.values():
        assert sum(r["size"] for r in members) <= packing.CAPACITY
        assert len({r["source"] for r in members}) == len(members)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
@pytest.mark.parametrize("table", ["odd_docs", "no_docs"])
def test_stages_take_odd_rows_and_return_the_columns(spark, name, stage, table, request):
    docs = request.getfixturevalue(table)
    out = stage(spark, docs, SF)
    if name != "packing":
        assert out.columns == docs.columns
        assert out.schema == docs.schema or [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    assert out.count() <= 10 * docs.count()
