from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pressure.llm import minhash
from tests.llm.conftest import words

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def shingles(text: str | None) -> frozenset:
    found = WORD.findall((text or "").translate(LOWER))
    if len(found) < 5:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + 5]) for i in range(len(found) - 4))


def brute(rows: list[tuple]) -> dict:
    """id -> (smallest id reachable), by comparing every pair of rows."""
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            shared = len(a & b)
            if a and b and 100 * shared >= 75 * (len(a) + len(b) - shared):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def edited(text: str, n: int, rng: random.Random) -> str:
    parts = text.split(" ")
    for _ in range(n):
        parts[rng.randrange(len(parts))] = f"w{rng.randrange(10**6)}"
    return " ".join(parts)


@pytest.fixture(scope="module")
def family():
    """A crowd of near copies around the threshold, exact copies, other case and spacing, short texts."""
    rng = random.Random(5)
    base = words(120, 7)
    rows = [(i, edited(base, rng.randint(0, 8), rng)) for i in range(400, 100, -1)]
    rows += [(1000 + i, base.upper() if i % 2 else base.replace(" ", "\t\n")) for i in range(30)]
    rows += [(2000 + i, words(rng.randint(0, 4), i % 5)) for i in range(40)]
    rows += [(3000 + i, words(60, 100 + i)) for i in range(60)] + [(4000, ""), (4001, None), (4002, " \n")]
    return rows


def test_sets_match_plain_shingling():
    texts = ["", "a", "a b c d", "A b c d e", "a b c d e f", "x y x y x y x y", "é É a\xa0b c d e f", " \t\na  b\x0bc"]
    got, counts = minhash.shingle_sets(texts)
    assert counts.tolist() == [len(shingles(t)) for t in texts]
    cut = np.split(got, np.cumsum(counts)[:-1])
    assert set(cut[3]) < set(cut[4]) and len(cut[3]) == 1
    assert len(minhash.shingle_sets(["", " "])[0]) == 0


def test_signatures_estimate_similarity():
    rng = random.Random(1)
    base = words(400, 3)
    for n in (2, 10, 20):
        other = edited(base, n, rng)
        got, counts = minhash.shingle_sets([base, other])
        a, b = shingles(base), shingles(other)
        rows = minhash.signatures(got, counts)
        assert abs((rows[0] == rows[1]).mean() - len(a & b) / len(a | b)) < 0.13


@pytest.mark.parametrize("block", [1024, 50])
def test_groups_match_comparing_all_pairs(spark, family, block, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", block)
    docs = spark.createDataFrame(family, "doc_id long, text string").repartition(7)
    got = minhash.near_duplicates(docs).collect()
    want = brute(family)
    sizes = {i: len(shingles(t)) for i, t in family}
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert len(got) == len(family)


def test_documents_match_comparing_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs).collect()} == brute(rows)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = minhash.near_duplicates(odd_docs).collect()
    want = brute(rows)
    expected = [(i, len(shingles(t)), want.get(i), i is None or want[i] == i) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert minhash.near_duplicates(no_docs).collect() == []
    one = minhash.keep_one(odd_docs)
    assert one.columns == odd_docs.columns
    kept = [r["doc_id"] for r in one.collect()]
    assert sorted(i for i in kept if i is not None) == sorted({i for i, root in want.items() if i == root})
    assert kept.count(None) == sum(i is None for i, _ in rows)


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", words(30, 1)), ("a", words(30, 1)), ("c", words(30, 2))], "name string, body string")
    got = minhash.near_duplicates(docs.withColumn("u", F.lit(1)), "name", "body").collect()
    assert {r["name"]: r["component_id"] for r in got} == {"a": "a", "b": "a", "c": "c"}


def test_one_member_far_from_the_first():
    """In a bucket (first, B, C) in which only C is far from the first, C still meets B; in a bucket of two it has nobody else."""
    values = 2 * minhash.PERMUTATIONS
    first = np.zeros(values, np.uint8)
    b, c = first.copy(), first.copy()
    b[: values // 5] = 1  # 0.8 of first
    c[: 2 * values // 5] = 1  # 0.6 of first, 0.8 of B
    rows = [(1, 10, first), (1, 11, b), (1, 12, c), (2, 20, first), (2, 21, c)]
    table = pa.table(
        {
            "bucket": [r[0] for r in rows],
            "p": [0] * len(rows),
            "q": [0] * len(rows),
            "id": [r[1] for r in rows],
            "signature": pa.array([r[2].tobytes() for r in rows], pa.binary()),
        }
    )
    one, two = minhash._similar_in_runs(table)
    found = {frozenset((rows[i][1], rows[j][1])) for i, j in zip(one.tolist(), two.tolist(), strict=True) if i != j}
    assert found == {frozenset((10, 11)), frozenset((11, 12))}


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    one, two, three = words(40, 11), words(40, 12), words(40, 13)
    near = one + " more"
    rows = [(1, one), (1, two), (2, near), (2, three), (3, two), (4, words(40, 14))] + [(5, words(30, 15))] * 2000 + [(None, one)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as __id", "2 as __number", "3 as __digest", "'x' as _row", "4 as _id")
    kept = sorted((str(r["doc_id"]), r["text"]) for r in minhash.keep_one(docs).collect())
    assert kept == sorted([("1", one), ("1", two), ("2", three), ("4", words(40, 14)), ("5", words(30, 15)), ("None", one), ("None", one)])
    unique = docs.where("doc_id IN (3, 4)")
    assert sorted(r["doc_id"] for r in minhash.keep_one(unique).collect()) == [3, 4]
