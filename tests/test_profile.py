from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pressure.operators import profile as P
from pressure.operators.dedup import extra_copies


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i % 17, (i * 7.25) % 31 if i % 5 else None, "ab"[i % 2] if i % 9 else None) for i in range(140)]
    return spark.createDataFrame([*rows, rows[3], rows[3]], "a long, b double, s string")


@pytest.mark.parametrize("bins", [4096, 2])
def test_describe_matches_pandas(table, bins):
    want = table.toPandas()[["a", "b"]].describe()
    got = {r["column"]: r for r in P.describe(table, ["a", "b"], bins).collect()}
    for column in ("a", "b"):
        for ours, theirs in zip(
            ("count", "mean", "std", "min", "p25", "p50", "p75", "max"),
            ("count", "mean", "std", "min", "25%", "50%", "75%", "max"),
        ):
            assert got[column][ours] == pytest.approx(want[column][theirs])


def test_describe_of_an_unknown_column(spark):
    empty = spark.createDataFrame([(None,), (None,)], "a double")
    row = P.describe(empty, ["a"]).first()
    assert row["count"] == 0 and row["p50"] is None and row["max"] is None


def test_quartiles_of_values_far_apart(spark):
    import random

    rng = random.Random(3)
    rows = [(rng.choice([-1, 1]) * 2.0 ** rng.uniform(-1070, 1020), 1.0 + i * 2.0**-52, float(2**53 - i)) for i in range(401)]
    rows += [(0.0, 1.0, None), (-0.0, float("inf"), 5e-324), (1.7e308, float("-inf"), -5e-324)]
    names = ["far", "near", "large"]
    df = spark.createDataFrame(rows, "far double, near double, large double")
    got = {r["column"]: r for r in P.describe(df, names).collect()}
    for k, name in enumerate(names):
        values = sorted(r[k] for r in rows if r[k] is not None)
        for part, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
            at = (len(values) - 1) * q
            low = int(at)
            want = values[low] if at == low else values[low] + (values[low + 1] - values[low]) * (at - low)
            assert got[name][part] == want


def test_quartiles_read_the_table_a_fixed_number_of_times_and_shuffle_bins(spark, monkeypatch):
    counts = []
    counted = P._Selection.counted
    monkeypatch.setattr(P._Selection, "counted", lambda self, rows, n: counts.append(len(rows)) or counted(self, rows, n))
    df = spark.range(100_000).select((F.col("id") % 1000).alias("a"), F.sqrt(F.col("id").cast("double") + 0.5).alias("b"))
    got = {r["column"]: r["p50"] for r in P.describe(df, ["a", "b"]).collect()}
    assert got["a"] == 499.5 and got["b"] == pytest.approx(223.607, abs=0.01)
    assert len([n for n in counts if n]) <= 6 and max(counts) <= 12


def test_counts(table):
    frame = table.toPandas()
    assert tuple(P.shape(table).first()) == (142, 3)
    nulls = {r["column"]: (r["type"], r["non_null"], r["nulls"]) for r in P.nulls(table).collect()}
    assert nulls["b"] == ("double", int(frame.b.count()), int(frame.b.isna().sum()))
    assert [(r["value"], r["n"]) for r in P.value_counts(table, "s").collect()] == sorted(
        frame.s.value_counts().items(), key=lambda pair: (-pair[1], pair[0])
    )
    assert {r["value"] for r in P.distinct_values(table, "s").collect()} == {"a", "b", None}
    assert extra_copies(table).first()["duplicates"] == int(frame.duplicated().sum())
    assert [(r["column"], r["min"], r["max"]) for r in P.extent(table, ["a", "b"]).collect()] == [
        ("a", 0.0, 16.0),
        ("b", float(frame.b.min()), float(frame.b.max())),
    ]
    assert [r["a"] for r in P.head(table, "a", 3).collect()] == [0, 0, 0]
    assert P.column_types(table) == [("a", "bigint"), ("b", "double"), ("s", "string")]
