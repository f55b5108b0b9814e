"""The sequence operators against plain loops on random small groups."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pressure.config import Limits
from pressure.operators.sequence import first_outcome, previous_row, split_by_size

SCHEMA = "g string, id long, t long, side string, kind string"


def make(seed: int, rows: int, jitter: int, sides: list, groups: int) -> list[tuple]:
    rng = random.Random(seed)
    clock = [0] * groups
    out = []
    for i in range(rows):
        g = 0 if rng.random() < 0.5 else rng.randrange(groups)
        clock[g] += rng.randrange(4)
        late = rng.randrange(jitter + 1) if rng.random() < 0.3 else 0
        t = None if rng.random() < 0.04 and jitter else clock[g] - late
        kind = rng.choice(["win", "shot", "stop", "play", "play"])
        name = None if g == 1 and jitter else f"g{g}"
        out.append((name, i + 1, t, rng.choice(sides), kind))
    return out


def by_hand(rows: list[tuple], horizon: int) -> dict[int, tuple]:
    want = {}
    for g, i, t, side, kind in rows:
        if kind != "win":
            continue
        end = hit = None
        for g2, i2, t2, side2, kind2 in rows:
            if g is None or g2 != g or i2 <= i or t is None or t2 is None or t2 > t + horizon:
                continue
            other = side is not None and side2 is not None and side2 != side
            if end is None and (other or kind2 == "stop"):
                end = i2
            if hit is None and kind2 == "shot" and side is not None and side2 == side:
                hit = i2
        want[i] = (end, hit if hit is not None and (end is None or hit < end) else None)
    return want


def run(spark, rows, horizon, limits, key=lambda g, i: i):
    df = spark.createDataFrame(rows, SCHEMA)

    def job(part, run):
        return first_outcome(
            part, ["g"], "id", "t", F.col("side"), F.col("kind") == "win", F.col("kind") == "shot",
            F.col("kind") == "stop", horizon, ["kind"], run,
        )

    rows = split_by_size(df, ["g"], "id", job, limits).collect()
    return {key(r["g"], r["id"]): (r["end"] and r["end"]["id"], r["hit"] and r["hit"]["id"]) for r in rows}


@pytest.mark.parametrize("limits", [Limits(), Limits(group_rows=20, chunk_rows=16)], ids=["whole", "cut"])
@pytest.mark.parametrize(
    ("jitter", "sides"),
    [
        (0, ["a", "b"]),
        (0, ["a", "b", "c"]),
        (12, ["a", "b"]),
        (40, ["a", "b", "c", "d"]),
        (40, ["a", "a", "a", None]),
        (5, ["a", "b", None]),
        (400, ["a"]),
    ],
)
def test_first_outcome(spark, limits, jitter, sides):
    rows = make(1, 400, jitter, sides, 5)
    assert run(spark, rows, 6, limits) == by_hand(rows, 6)


@pytest.mark.parametrize("limits", [Limits(), Limits(group_rows=20, chunk_rows=16)], ids=["whole", "cut"])
@pytest.mark.parametrize("step", [1, 1_000_003])
@pytest.mark.parametrize("jitter", [0, 40])
def test_order_values_may_repeat_in_other_groups(spark, limits, step, jitter):
    """Ids that start anew in every group, next to each other or far apart, with and without late clocks."""
    rows = make(3, 300, jitter, ["a", "b"], 4)
    seen, again = {}, []
    for g, _, t, side, kind in rows:
        seen[g] = seen.get(g, 0) + 1
        again.append((g, seen[g] * step, t, side, kind))
    want = {}
    for g in seen:
        own = [r for r in again if r[0] == g]
        want |= {(g, i): found for i, found in by_hand(own, 6).items()}
    assert run(spark, again, 6, limits, lambda g, i: (g, i)) == want


def test_an_answer_of_another_group_is_not_taken(spark):
    rows = [("a", 1, 0, "x", "win"), ("a", 2, 30, "x", "play"), ("a", 3, 5, "x", "shot")]
    rows += [("b", 1, 0, "x", "win"), ("b", 2, 30, "x", "play"), ("b", 3, 5, "x", "stop")]
    got = run(spark, rows, 10, Limits(), lambda g, i: (g, i))
    assert got == {("a", 1): (None, 3), ("b", 1): (3, None)}


@pytest.mark.parametrize("step", [1, 1_000_003])
def test_runs_hold_so_many_rows_however_sparse_the_order(spark, step):
    df = spark.range(1000).selectExpr("'g' AS g", f"id * {step} AS id")
    sizes = []

    def job(part, run):
        if run:
            sizes.extend(r["count"] for r in part.groupBy(run).count().collect())
        return part

    assert split_by_size(df, ["g"], "id", job, Limits(group_rows=50, chunk_rows=100, one_task_rows=300)).count() == 1000
    assert max(sizes) <= 100 and len(sizes) <= 11


@pytest.mark.parametrize("limits", [Limits(), Limits(group_rows=20, chunk_rows=16)], ids=["whole", "cut"])
def test_previous_row(spark, limits):
    rows = make(5, 300, 30, ["a", None], 4)
    df = spark.createDataFrame(rows, SCHEMA)
    got = split_by_size(df, ["g"], "id", lambda d, c: previous_row(d, ["g"], "id", ["side", "kind"], c), limits)
    seen, want = {}, {}
    for g, i, _, side, kind in rows:
        want[i] = seen.get(g)
        seen[g] = (side, kind)
    assert {r["id"]: r["previous"] and (r["previous"]["side"], r["previous"]["kind"]) for r in got.collect()} == want


def test_only_the_large_group_is_cut(spark):
    df = spark.range(100).selectExpr("IF(id < 90, 'big', CAST(id AS STRING)) AS g", "id")
    parts = {}

    def job(part, run):
        parts[run] = sorted({r["g"] for r in part.select("g").distinct().collect()})
        return part

    assert split_by_size(df, ["g"], "id", job, Limits(group_rows=50, chunk_rows=10)).count() == 100
    assert parts["_run"] == ["big"] and len(parts[None]) == 10


def test_no_join_and_one_shuffle_for_ordinary_groups(spark):
    df = spark.createDataFrame(make(1, 50, 0, ["a", "b"], 3), SCHEMA)
    plan = previous_row(df, ["g"], "id", ["side"], None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Python" not in plan
