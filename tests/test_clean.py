from __future__ import annotations

from datetime import date

import pytest

from pressure.config import Limits
from pressure.plans import clean
from tests.rows import PREFIX, raw_row, raw_table


def cleaned(spark, rows, **kw):
    return {r["event_id"]: r for r in clean.clean_events(raw_table(spark, rows), **kw).collect()}


def test_zone_thresholds(spark):
    rows = [raw_row(i, x=x) for i, x in enumerate([125.0, 124.9, 75.0, 75.1, 100.0, None, 200.0, 0.0])]
    got = cleaned(spark, rows)
    assert [got[i]["zone"] for i in range(8)] == ["OZ", "NZ", "DZ", "NZ", "NZ", "NZ", "OZ", "DZ"]


def test_strength_rules_in_order(spark):
    sides = [(6, 6), (5, 6), (5, 4), (4, 5), (5, 5), (None, 4), (5, None)]
    rows = [raw_row(i, home_skaters=h, away_skaters=a) for i, (h, a) in enumerate(sides)]
    got = cleaned(spark, rows)
    assert [got[i]["strength_state"] for i in range(7)] == ["EA", "EN", "PP", "PK", "EV", "EV", "EV"]
    assert [got[i]["skater_state"] for i in range(7)] == ["6v6", "5v6", "5v4", "4v5", "5v5", None, None]


def test_away_side_sees_the_game_from_its_own_view(spark):
    got = cleaned(spark, [raw_row(1, team="Blue", home_skaters=5, away_skaters=4)])[1]
    assert (got["is_home"], got["opponent"], got["team_skaters"], got["opp_skaters"]) == (False, "Red", 4, 5)
    assert got["strength_state"] == "PK"


def test_a_third_team_counts_as_away_and_plays_the_home_team(spark):
    got = cleaned(spark, [raw_row(1, team="Green")])[1]
    assert (got["is_home"], got["opponent"]) == (False, "Red")


def test_clock(spark):
    clocks = [" 20:00", "00:00", None, "19:05 "]
    got = cleaned(spark, [raw_row(i, clock=c) for i, c in enumerate(clocks)])
    assert [got[i]["clock_seconds"] for i in range(4)] == [1200, 0, None, 1145]
    assert [got[i]["period_elapsed"] for i in range(4)] == [0, 1200, None, 55]
    assert [got[i]["clock"] for i in range(4)] == ["20:00", "00:00", None, "19:05"]


def test_a_bad_clock_is_an_error(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.clean_events(raw_table(spark, [raw_row(1, clock="late")])).collect()


def test_shot_flag_reads_the_untrimmed_event(spark):
    got = cleaned(spark, [raw_row(1, " Shot "), raw_row(2, "Shot"), raw_row(3, "Goal"), raw_row(4, "Play")])
    assert [got[i]["event"] for i in (1, 2, 3, 4)] == ["Shot", "Shot", "Goal", "Play"]
    assert [got[i]["is_shot"] for i in (1, 2, 3, 4)] == [0, 1, 1, 0]


def test_copies_that_differ_only_in_padding_merge_into_the_lowest_id(spark):
    rows = [raw_row(7, player="Ann", detail=None), raw_row(3, player=" Ann "), raw_row(9, player="Ann", detail=" ")]
    got = cleaned(spark, rows)
    assert sorted(got) == [3, 9]


def test_games_rank_over_kept_rows_only(spark):
    days = {1: date(2020, 1, 1), 2: date(2020, 1, 2), 3: date(2020, 1, 3)}
    other = "NCAA - Red"
    rows = [raw_row(1, day=days[3]), raw_row(2, day=days[2], home=other), raw_row(3, day=days[1]), raw_row(4, home=None)]
    got = cleaned(spark, rows)
    assert {i: r["game_id"] for i, r in got.items()} == {3: 1, 1: 2}
    assert {r["league"] for r in got.values()} == {"Olympic"}


def test_unknown_dates_and_opponents_form_games_too(spark):
    rows = [raw_row(1, day=None), raw_row(2, away=None), raw_row(3)]
    got = cleaned(spark, rows)
    assert {i: r["game_id"] for i, r in got.items()} == {3: 1, 2: 2, 1: 3}


def test_game_ids_are_the_same_when_ranked_in_ranges(spark):
    rows = [raw_row(i, day=date(2020, 1 + i % 9, 1 + i % 27), away=f"{PREFIX}T{i % 5}") for i in range(300)]
    raw = raw_table(spark, rows)
    one = clean.game_ids(raw).collect()
    many = clean.game_ids(raw, limits=Limits(one_task_rows=10)).collect()
    assert sorted(map(tuple, one), key=str) == sorted(map(tuple, many), key=str)
    assert sorted(r["game_id"] for r in many) == list(range(1, len(many) + 1))
