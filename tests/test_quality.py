from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pressure.operators import quality as Q
from pressure.plans import checks as C


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, "a", 1), (2, "a", 1), (3, "b", None), (4, None, 5), (4, "z", 6)]
    return spark.createDataFrame(rows, "id long, s string, v int")


def result(df):
    (row,) = df.collect()
    return row["checked"], row["violations"]


def test_each_check_counts_its_violations(spark, table):
    assert result(Q.expected_rows("c", table, 7)) == (5, 2)
    assert result(Q.same_row_count("c", table, table.limit(2))) == (5, 3)
    assert result(Q.unique_rows("c", table, "id")) == (5, 1)
    assert result(Q.unique_key("c", table, ["id"])) == (5, 1)
    assert result(Q.distinct_ids("c", table, "id")) == (5, 1)
    assert result(Q.accepted_values("c", table, "s", ["a", "b"])) == (5, 2)
    other = spark.createDataFrame([(1, None), (2, 1), (3, None)], "id long, w int")
    assert result(Q.null_parity("c", table, "v", other, "w", "id")) == (3, 1)
    both = Q.rows_where(table, {"null": F.col("v").isNull(), "big": F.col("v") > 4})
    assert [tuple(r) for r in both.collect()] == [("null", 5, 1), ("big", 5, 2)]


def test_parity_joins_only_ranges_that_differ(spark, monkeypatch):
    monkeypatch.setattr(Q, "RANGE_KEYS", 100)
    left = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"))
    same = left.select("id", F.col("v").cast("string").alias("w")).repartition(7)
    equal = Q.null_parity("c", left, "v", same, "w", "id")
    assert result(equal) == (1000, 0)
    assert "Join" not in equal._jdf.queryExecution().executedPlan().toString()
    planted = same.withColumn("w", F.when(~F.col("id").isin(5, 6, 418), F.col("w")).otherwise(F.when(F.col("id") == 6, "x")))
    assert result(Q.null_parity("c", left, "v", planted, "w", "id")) == (1000, 3)
    doubled = left.unionAll(left.where("id < 150"))
    assert result(Q.null_parity("c", doubled, "v", planted, "w", "id")) == (1150, 5)
    assert result(Q.null_parity("c", left.where("id >= 300"), "v", same.where("id < 700"), "w", "id")) == (400, 0)
    negative = left.select((F.col("id") - 500).alias("id"), "v")
    assert result(Q.null_parity("c", negative, "v", same, "w", "id"))[0] == 500


def test_checks_on_nothing(table):
    none = table.limit(0)
    assert result(Q.unique_key("c", none, ["id"])) == (0, 0)
    assert result(Q.accepted_values("c", none, "s", ["a"])) == (0, 0)
    assert result(Q.same_row_count("c", none, none)) == (0, 0)
    assert result(Q.unique_rows("c", none, "id")) == (0, 0)
    assert result(Q.null_parity("c", none, "v", none, "s", "id")) == (0, 0)


def test_built_tables_pass(layers):
    got = {r["check"]: r for r in C.table_checks(layers).collect()}
    assert len(got) == 24 and all(r["violations"] == 0 for r in got.values())


def test_broken_tables_fail(spark, layers):
    from dataclasses import replace

    flipped = layers.wins.withColumn("led_to_shot", ~F.col("led_to_shot"))
    doubled = layers.events.unionAll(layers.events.filter("event_id % 10 = 0"))
    got = {r["check"]: r["violations"] for r in C.table_checks(replace(layers, wins=flipped, events=doubled)).collect()}
    assert got["end reason agrees with the shot flag"] == 1188
    assert got["credited shot has an id"] == 1040
    assert got["no shot id without a credited shot"] == 148
    assert got["one fact per clean event"] == layers.events.filter("event_id % 10 = 0").count()


def test_known_totals(layers):
    rows = {"raw": 10104, "clean": 8750, "games": 35, "teams": 4, "players": 142, "events": 8750, "wins": 1188}
    totals = {"wins": 1188, "recoveries": 1026, "takeaways": 162, "shots": 148, "goals": 37, "rebound_goals": 1}
    good = C.known_total_checks(layers, rows, 0.125, totals).collect()
    assert len(good) == 14 and all(r["violations"] == 0 for r in good)
    bad = C.known_total_checks(layers, {"wins": 1180}, 0.408, {"shots": 1}).collect()
    assert [r["violations"] for r in bad] == [8, 1, 1]


def test_report_checks_read_the_counted_wins_once_and_count_faults(spark, layers, monkeypatch):
    from pressure.plans import marts as M

    kept = []
    keep = C.keep
    monkeypatch.setattr(C, "keep", lambda df, label: kept.append(df) or keep(df, label))
    sets = [M.Filters(), M.Filters(team="North"), M.Filters(team="North", player="Nobody")]
    good = C.report_checks(layers.win_tables, sets, [(M.Filters(), 20), (M.Filters(player="Nobody"), 1)])
    assert len(kept) == 1
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "win_counts" not in plan  # everything else comes from the sums
    got = {r["check"]: (r["checked"], r["violations"]) for r in good.collect()}
    assert got["cells add up: no filter"] == (1188, 0) and got["cells add up: team=North, player=Nobody"] == (0, 0)
    assert got["table minimum: player=Nobody"] == (0, 0) and all(v == 0 for _, v in got.values())

    faulty = layers.wins.withColumns(
        {
            "x_coord": F.when(F.col("event_id") % 7 == 0, 10).otherwise(F.col("x_coord")),
            "win_type": F.when(F.col("event_id") % 5 == 0, "Mystery").otherwise(F.col("win_type")),
            "led_to_shot": ~F.col("led_to_shot"),
        }
    )
    tables = M.WinTables(M.win_counts(faulty), layers.teams, layers.players)
    bad = {r["check"]: (r["checked"], r["violations"]) for r in C.report_checks(tables, sets, [(M.Filters(), 25)]).collect()}
    assert bad["cells add up: no filter"] == (1188, layers.wins.filter("event_id % 7 = 0").count())
    mystery = layers.wins.filter("event_id % 5 = 0").count()
    assert bad["win types add up: no filter"] == (1188, mystery) and bad["win type agrees: Mystery"] == (mystery, 1)
    assert bad["shot end reason is the shots: no filter"] == (1040, 1040 - 148)
    players = M.player_table(tables).filter(F.col("OZ Wins") < 25).count()
    assert bad["table minimum: no filter"][1] == players > 0
