from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressure.llm import ann, caps

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def brute_links(rows):
    good = [(i, np.array(v, np.float64), c) for i, v, c in rows if i is not None and c is not None and usable(v)]
    links, parent = {}, {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for k, (i, a, c) in enumerate(good):
        for j, b, e in good[:k]:
            if c == e and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98:
                links[i], links[j] = links.get(i, 0) + 1, links.get(j, 0) + 1
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: (links.get(i, 0), root(i)) for i, _, _ in rows if i is not None}


@pytest.fixture(scope="module")
def crowd():
    """Near copies at all cosines around the threshold, exact copies, two labels, one crowd."""
    rng = np.random.default_rng(3)
    rows = []
    for c in range(12):
        centre = rng.normal(size=24)
        for _ in range(40 if c else 150):
            v = centre + rng.normal(size=24) * rng.uniform(0, 0.25)
            rows.append(v.astype(np.float32).tolist())
    rows += [rows[0]] * 60 + [rng.normal(size=24).astype(np.float32).tolist() for _ in range(100)]
    order = rng.permutation(len(rows))
    return [(int(order[k]), v, int(k % 10 == 9)) for k, v in enumerate(rows)]


ODD = [
    (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [float("nan"), 1.0], 1), (6, [float("inf"), 1.0], 1),
    (7, [1.0, 2.0], 1), (8, [2.0, 4.0], 1), (9, [1.0, 2.0], None), (None, [1.0, 2.0], 1), (11, [1.0, 2.0, 0.0], 1), (12, [1.0, 2.0], 2),
    (20, [1.0, 2.0], 1), (40, [-1.0, 2.5], 1), (60, [3e38, 3e38], 1), (80, [1e-30, 0.0], 1), (100, [2.0, 4.0], 2), (120, None, 1),
]


@pytest.mark.parametrize("block", [1024, 32])
def test_links_match_comparing_all_pairs(spark, crowd, block, monkeypatch):
    monkeypatch.setattr(caps, "BLOCK_MEMBERS", block)
    got = caps.near_duplicates(spark.createDataFrame(crowd, SCHEMA)).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == brute_links(crowd)
    assert len(got) == len(crowd)


@pytest.mark.parametrize("length", [2, 3, 8, 16, 31, 32, 64, 128])
def test_caps_find_pairs_at_the_threshold(length):
    rng = np.random.default_rng(1)
    x = caps._unit(rng.normal(size=(2000, length)))
    z = rng.normal(size=x.shape)
    z = caps._unit(z - (z * x).sum(1, keepdims=True) * x)
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * z
    met, several = np.zeros(len(x), bool), 0
    for number in range(caps.CODES):
        both = [caps.filters(v, number) for v in (x, y)]
        one, two = (set(zip(*(a.tolist() for a in found), strict=True)) for found in both)
        met[[row for row, _ in one & two]] = True
        several += len(one) / len(x)
    assert met.mean() >= 0.999
    assert several <= 3 * caps.WANTED


@pytest.mark.parametrize("length", [1, 3, 8, 20, 40])
def test_filters_are_all_that_exceed_the_cap(length):
    rng = np.random.default_rng(2)
    x = caps._unit(rng.normal(size=(20, length)))
    rotation, directions = caps.code(length, 0)
    row, found = caps.filters(x, 0)
    turned = (x @ rotation).reshape(20, len(directions), -1)
    score = np.einsum("nbw,bdw->nbd", turned, directions)
    every = np.zeros((20, 1))
    for block in range(len(directions)):
        every = (every[:, :, None] + score[:, block, None, :]).reshape(20, -1)
    cap, margin = caps.cap(length)
    need = np.minimum(cap, every.max(1) - margin)
    for i in range(20):
        assert sorted(found[row == i]) == np.flatnonzero(every[i] >= need[i] - 1e-12).tolist()


def test_one_measure_decides_at_the_threshold(spark):
    """A pair that falls short of the threshold by 4e-13 is linked nowhere; one at it is linked in full."""
    short, at = (np.array([c, np.sqrt(1 - c * c)]) for c in (0.98 - 4e-13, 0.98 + 4e-13))
    rows = [(1, [1.0, 0.0], 1), (2, short.tolist(), 1), (3, [1.0, 0.0], 2), (4, at.tolist(), 2)]
    got = caps.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == {
        1: (0, 1, True), 2: (0, 2, True), 3: (1, 3, True), 4: (1, 3, False),
    }


def test_odd_vectors_link_with_nothing(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    clash = df.select("*", *[F.lit(1).alias(c) for c in ("id", "vector", "rows", "own", "p", "component", "score")])
    got = caps.near_duplicates(clash).collect()
    want = brute_links(ODD)
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got if r["vec_id"] is not None} == want
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is None] == [(0, None, True)]
    assert caps.near_duplicates(clash.limit(0)).collect() == []
    assert len(got) == len(ODD)


def brute_nearest(rows, k):
    good = [(i, np.array(v, np.float64)) for i, v, _ in rows if i is not None and usable(v)]
    out = {}
    for i, q in good:
        if i % 20 == 0:
            found = sorted((-float(q @ x), j) for j, x in good if j != i and len(x) == len(q))[:k]
            out[i] = [(j, -s) for s, j in found]
    return out


def compare(got, want):
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert {q for q, w in want.items() if w} == set(found)
    hits = total = 0
    for q, w in want.items():
        hits += len({i for i, _ in w} & {i for i, _ in found.get(q, [])})
        total += len(w)
        assert len(found.get(q, [])) == len(w)
    return hits / max(total, 1)


@pytest.mark.parametrize("part", [8192, 100])
def test_recall_over_many_cells(spark, crowd, part, monkeypatch):
    monkeypatch.setattr(ann, "PART", part)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 16)
    monkeypatch.setattr(ann, "LEAF", 32)
    got = ann.nearest(spark.createDataFrame(crowd, SCHEMA), F.col("vec_id") % 20 == 0, 20).collect()
    assert compare(got, brute_nearest(crowd, 20)) >= 0.95


def test_embeddings_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], None) for r in df.collect()]
    assert compare(ann.nearest(df, F.col("vec_id") % 20 == 0, 20).collect(), brute_nearest(rows, 20)) >= 0.95


def test_ties_and_odd_vectors(spark):
    rows = [(i, [1.0, 2.0], 1) for i in range(1, 90)] + [(200 + i, [float(i), -1.0], 1) for i in range(5)]
    got = ann.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect()
    want = brute_nearest(rows, 20)
    for q, w in want.items():
        assert [r["vec_id"] for r in got if r["query_id"] == q] == [i for i, _ in w]
    odd = spark.createDataFrame(ODD, SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("id", "vector", "cell", "part", "asks", "bound")])
    assert compare(ann.nearest(odd, F.col("vec_id") % 20 == 0, 20).collect(), brute_nearest(ODD, 20)) == 1
    assert ann.nearest(odd.limit(0), F.col("vec_id") % 20 == 0, 20).collect() == []


def test_repeated_rows_count_once(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist(), 1) for i in range(60)]
    repeated = spark.createDataFrame(rows * 3 + rows[:1] * 3000, SCHEMA)
    got = ann.nearest(repeated, F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect()
    want = brute_nearest(rows, 20)
    assert {q: [r["vec_id"] for r in got if r["query_id"] == q] for q in want} == {q: [i for i, _ in w] for q, w in want.items()}


def test_chi_square():
    assert abs(ann.chi_square_quantile(0.95, 8) - 15.507) < 0.01
