from __future__ import annotations

from pressure.plans.build import build_scratch
from pressure.sources.schemas import DIM_GAME_COLUMNS, FACT_EVENT_COLUMNS
from tests.rows import raw_row, raw_table


def built(spark, rows):
    return build_scratch(raw_table(spark, rows))


def test_second_player_belongs_to_the_opponent_on_contested_events(spark):
    rows = [
        raw_row(1, "Faceoff Win", player_2="Cy"),
        raw_row(2, "Penalty Taken", player_2="Di"),
        raw_row(3, "Zone Entry", player_2="Ed"),
        raw_row(4, "Play", player_2="Flo"),
        raw_row(5, "Play", team="Blue"),
    ]
    t = built(spark, rows)
    teams = {r["player_name"]: r["team_name"] for r in t.players.collect()}
    assert (teams["Cy"], teams["Di"], teams["Ed"], teams["Flo"]) == ("Blue", "Blue", "Blue", "Red")
    keys = {r["event_id"]: r["event_player2_key"] for r in t.events.collect()}
    assert keys[5] is None and len({keys[i] for i in (1, 2, 3, 4)}) == 4


def test_one_name_on_two_teams_is_two_players_and_does_not_fan_out(spark):
    rows = [raw_row(1, player="Ann"), raw_row(2, player="Ann", team="Blue"), raw_row(3, player="Ann", at=5)]
    t = built(spark, rows)
    assert t.players.count() == 2
    keys = {r["event_id"]: r["event_player_key"] for r in t.events.collect()}
    assert len(keys) == 3 and keys[1] == keys[3] != keys[2]


def test_a_player_without_a_name_never_gets_a_key(spark):
    t = built(spark, [raw_row(1, player=None), raw_row(2, player="no player 1")])
    keys = {r["event_id"]: (r["event_player_key"], r["event_player2_key"]) for r in t.events.collect()}
    assert keys[1] == (None, None) and keys[2] == (1, None)
    assert [r["player_name"] for r in t.players.orderBy("player_key").collect()] == ["no player 1", None]


def test_keys_follow_names_with_unknown_last(spark):
    rows = [raw_row(i, team=name) for i, name in enumerate(["Red", "Blue", "Amber"])]
    t = built(spark, rows)
    assert [tuple(r) for r in t.teams.orderBy("team_key").collect()] == [
        (1, "Amber", "Olympic"),
        (2, "Blue", "Olympic"),
        (3, "Red", "Olympic"),
    ]


def test_opponent_that_never_acts_has_no_key(spark):
    t = built(spark, [raw_row(1)])
    assert t.events.first()["opponent_team_key"] is None


def test_scores_and_winner(spark):
    from datetime import date

    rows = [raw_row(1, "Goal"), raw_row(2, "Goal", team="Blue"), raw_row(3, "Shot")]
    rows += [raw_row(10, "Goal", team="Blue", day=date(2020, 1, 2)), raw_row(11, " Goal ", day=date(2020, 1, 3))]
    games = built(spark, rows).games
    assert games.columns == list(DIM_GAME_COLUMNS)
    assert [(r["home_score"], r["away_score"], r["total_game_goals"], r["winner"]) for r in games.orderBy("game_key").collect()] == [
        (1, 1, 2, "Shootout"),
        (0, 1, 1, "Blue"),
        (1, 0, 1, "Red"),
    ]


def test_game_clock_runs_on_over_periods(spark):
    t = built(spark, [raw_row(1, period=1, at=7), raw_row(2, period=4, at=7)])
    assert t.events.columns == list(FACT_EVENT_COLUMNS)
    assert {r["event_id"]: r["game_seconds"] for r in t.events.collect()} == {1: 7, 2: 3607}
