"""Reports agree with each other under every filter set, and keep their edge rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import check_sql
from pressure.functions import edge
from pressure.plans import checks as C
from pressure.plans import marts as M
from pressure.plans.build import build_scratch
from tests.rows import raw_row, raw_table

SETS = [M.Filters(**f) for f in check_sql.FILTER_SETS]


@pytest.fixture(scope="module")
def tables(layers):
    small = M.WinTables(layers.counts.cache(), layers.teams.cache(), layers.players.cache())
    yield small
    for df in (small.counts, small.teams, small.players):
        df.unpersist()


@pytest.mark.parametrize("filters", SETS, ids=C.filter_name)
def test_breakdowns_add_up_to_the_summary(tables, filters):
    total = edge.single(M.summary(tables, filters))
    grid = sum(r["n"] for r in edge.records(M.shot_rate_grid(tables, filters)))
    reasons = {r["end_reason"]: r["totals"] for r in edge.records(M.end_reasons(tables, filters))}
    assert grid == total["wins"] == sum(reasons.values())
    assert reasons.get("shot", 0) == total["shots"]
    if filters.win_type is None:
        types = M.shot_rate_by_win_type(tables, filters.team, filters.player, filters.strength)
        assert sum(r["wins"] for r in edge.records(types)) == total["wins"]


def test_known_totals(tables):
    got = edge.single(M.summary(tables))
    assert {k: got[k] for k in ("wins", "recoveries", "takeaways", "shots", "goals", "rebound_goals", "med_secs")} == {
        "wins": 1188, "recoveries": 1026, "takeaways": 162, "shots": 148, "goals": 37, "rebound_goals": 1, "med_secs": 4.0,
    }
    assert edge.single(M.headline(tables)) == {"wins": 1188, "shot_rate": 0.125}


def test_nothing_selected(tables):
    got = edge.single(M.summary(tables, M.Filters(team="North", player="Nobody")))
    assert (got["wins"], got["shots"], got["rate"], got["med_secs"]) == (0, 0, None, None)
    assert edge.records(M.shot_rate_grid(tables, M.Filters(team="Nowhere"))) == []


def test_win_type_filter_matches_the_comparison(tables):
    compared = {r["win_type"]: r["wins"] for r in edge.records(M.shot_rate_by_win_type(tables))}
    listed = edge.values(M.win_type_list(tables))
    assert listed == sorted(compared)
    alone = {t: edge.single(M.summary(tables, M.Filters(win_type=t)))["wins"] for t in listed}
    assert alone == compared


def test_player_table_minimum(tables):
    assert [M.table_minimum(f) for f in (M.Filters(), M.Filters(team="North"), M.Filters(strength="PP"))] == [20, 20, 5]
    assert M.table_minimum(M.Filters(player="x", win_type="Rebound")) == 1
    plain = edge.records(M.player_table(tables))
    assert plain and min(r["OZ Wins"] for r in plain) >= 20
    assert [r["OZ Wins"] for r in plain] == sorted((r["OZ Wins"] for r in plain), reverse=True)
    typed = edge.records(M.player_table(tables, M.Filters(win_type="Forecheck Retrieval")))
    assert typed == [] or min(r["OZ Wins"] for r in typed) >= 5


def test_choosing_a_low_volume_player_lists_that_player(tables):
    lowest = edge.single(M.lowest_volume_player(tables, below=10_000))
    chosen = edge.records(M.player_table(tables, M.Filters(player=lowest["player_name"])))
    assert {r["Player"] for r in chosen} == {lowest["player_name"]}
    assert sum(r["OZ Wins"] for r in chosen) == lowest["wins"]


def test_lists(tables):
    assert edge.values(M.team_list(tables)) == ["East", "North", "South", "West"]
    players = edge.values(M.player_list(tables, "North"))
    assert players == sorted(players) and set(players) <= set(edge.values(M.player_list(tables)))


def test_shares(tables):
    got = edge.records(M.end_reason_shares(tables))
    assert abs(sum(r["pct"] for r in got) - 1) < 1e-12
    assert {r["end_reason"]: r["label"] for r in got}["stoppage"] == "Whistle"
    assert [r["totals"] for r in got] == sorted((r["totals"] for r in got), reverse=True)


def test_grid_edges(spark):
    places = [(125.0, 0.0), (139.9, 16.9), (200.0, 85.0), (150.0, None), (150.0, -1.0)]
    rows = [raw_row(i, "Puck Recovery", x=x, y=y) for i, (x, y) in enumerate(places)]
    grid = M.shot_rate_grid(build_scratch(raw_table(spark, rows)).win_tables)
    got = {(r["bx"], r["by_"]): (r["n"], r["cx"], r["cy"]) for r in edge.records(grid)}
    assert got == {
        (0.0, 0.0): (2, 32.5, -34.0),
        (4.0, 4.0): (1, 92.5, 34.0),
        (1.0, 4.0): (1, 47.5, 34.0),
        (1.0, -1.0): (1, 47.5, -51.0),
    }


def test_medians_of_even_counts_fall_between(spark):
    counts = spark.createDataFrame([(1, 2), (2, 1), (5, 3), (None, 9)], "seconds_to_shot int, n long")
    assert counts.agg(M._median_seconds().alias("m")).first()["m"] == 3.5


def test_counts_are_the_wins(layers):
    assert layers.counts.agg(F.sum("n")).first()[0] == layers.wins.count()
