from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pressure.operators.dedup import extra_copies, first_of_equals
from pressure.operators import ordering
from pressure.operators.ordering import part_count, row_numbers, running_total


@pytest.mark.parametrize("one_task_rows", [1000, 30, 1])
def test_row_numbers(spark, one_task_rows):
    df = spark.range(60).select(((F.col("id") * 37) % 61).alias("k"), F.col("id").alias("v")).unionByName(
        spark.createDataFrame([(None, 99)], "k long, v long")
    )
    got = row_numbers(df, ["k"], "n", one_task_rows).orderBy("n").collect()
    known = [r["k"] for r in got[:-1]]
    assert [r["n"] for r in got] == list(range(1, 62)) and known == sorted(known) and got[-1]["k"] is None
    assert row_numbers(df, ["k"], "n", one_task_rows).schema["n"].dataType.typeName() == "long"


@pytest.mark.parametrize("one_task_rows", [1000, 7])
def test_running_total(spark, one_task_rows):
    df = spark.range(50).select("id", (F.col("id") % 5).alias("w"))
    got = running_total(df, ["id"], "s", F.col("w"), one_task_rows).orderBy("id").collect()
    total = 0
    for row in got:
        total += row["w"]
        assert row["s"] == total


def test_low_limits_ask_for_no_more_ranges_than_a_shuffle_has(spark, monkeypatch):
    kept = []

    def keep(df, label):
        kept.append(df)
        return df

    monkeypatch.setattr(ordering, "keep", keep)
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = row_numbers(spark.range(40 * shuffled), ["id"], "n", 2)
    assert got.where("n != id + 1").isEmpty()
    (ranged,) = kept
    assert 1 < ranged.select("_range").distinct().count() <= shuffled
    assert part_count(spark, 36_000_000, 16, 16) == max(shuffled, 360)
    # Other limits stand: ranges of 1,000,000 rows, and of 200,000.
    assert part_count(spark, 10**9, 10**6, 10**6) == max(shuffled, 1000)
    assert part_count(spark, 10**9, 200_000, 200_000) == 5000
    assert part_count(spark, 0, 16, 16) == 1


def test_copies(spark):
    rows = [(5, "a", None), (2, "a", None), (9, "a", 1.0), (4, "b", None), (7, "a", None)]
    df = spark.createDataFrame(rows, "id long, s string, x double")
    assert sorted(r["id"] for r in first_of_equals(df, "id").collect()) == [2, 4, 9]
    assert extra_copies(df, "id").first()["duplicates"] == 2
    assert extra_copies(df).first()["duplicates"] == 0
    assert extra_copies(df.limit(0)).first()["duplicates"] == 0


def test_rows_whose_fingerprints_meet_are_compared(spark, monkeypatch):
    from pressure.operators import dedup

    rows = [(i, i % 7 or None, "ab"[i % 2] if i % 3 else None) for i in range(60)] + [(60, None, "1"), (61, 1, None)]
    df = spark.createDataFrame(rows, "id long, a long, b string")
    want = len(rows) - len({r[1:] for r in rows})
    assert extra_copies(df, "id").first()["duplicates"] == want
    assert dedup.fingerprint(["a", "b"])[0] is not None
    swapped = df.where("id >= 60").select(*dedup.fingerprint(["a", "b"])).collect()
    assert swapped[0] != swapped[1]
    monkeypatch.setattr(dedup, "fingerprint", lambda columns: [F.lit(1), F.lit(2)])
    assert extra_copies(df, "id").first()["duplicates"] == want
