from __future__ import annotations

from datetime import date, timedelta

from pressure.config import Limits, Rules
from pressure.plans import wins as W
from pressure.plans.build import build_scratch
from tests.rows import raw_row, raw_table

WIN = "Puck Recovery"


def outcome(spark, rows, **kw):
    t = build_scratch(raw_table(spark, rows))
    return {r["event_id"]: r for r in W.fact_puck_wins(t.events, **kw).collect()}


def games(spark, cases: list[list[dict]]) -> list[dict]:
    """Builds each case as a game of its own, all in one run; rows are numbered from 1 per game."""
    rows, days = [], []
    for number, case in enumerate(cases):
        days.append(date(2020, 1, 1) + timedelta(days=number))
        rows += [raw_row(100 * number + i, day=days[-1], **event) for i, event in enumerate(case, 1)]
    found = outcome(spark, rows)
    return [{i % 100: r for i, r in found.items() if i // 100 == number} for number in range(len(cases))]


def test_win_types(spark):
    cases = [
        (None, WIN, "Support"),
        (None, "Takeaway", "Forced Turnover"),
        ({"event": "Shot"}, WIN, "Rebound"),
        ({"event": "Shot"}, "Takeaway", "Rebound"),
        ({"event": "Goal"}, WIN, "Support"),
        ({"event": "Faceoff Win"}, WIN, "Faceoff"),
        ({"event": "Dump In/Out"}, WIN, "Forecheck Retrieval"),
        ({"event": "Zone Entry", "detail": "Dumped"}, WIN, "Forecheck Retrieval"),
        ({"event": "Zone Entry", "detail": "Carried"}, WIN, "Support"),
        ({"event": "Zone Entry", "detail": "Dumped", "team": "Blue"}, WIN, "Forced Turnover"),
        ({"event": "Play", "detail": "Dumped"}, WIN, "Support"),
        ({"event": "Shot", "team": "Blue"}, WIN, "Forced Turnover"),
        ({"event": "Play", "x": 10.0}, "Takeaway", "Forced Turnover"),
        ({"event": "Shot", "period": 0}, "Takeaway", "Other / Loose Puck"),
    ]
    # The second team acts once in every game so that it has a key; it does so after the window.
    late = {"event": "Play", "team": "Blue", "at": 90}
    built = games(spark, [[*([before] if before else []), {"event": event, "at": 30}, late] for before, event, _ in cases])
    got = [game[2 if before else 1]["win_type"] for game, (before, _, _) in zip(built, cases)]
    assert got == [expected for _, _, expected in cases]


def test_end_reasons(spark):
    cases = [
        ([{"event": "Shot", "at": 110}], "shot"),
        ([{"event": "Shot", "at": 111}], "time_expired"),
        ([{"event": "Play", "at": 105}], "time_expired"),
        ([], "time_expired"),
        ([{"event": "Play", "team": "Blue", "at": 105}, {"event": "Shot", "at": 105}], "opponent_possession"),
        ([{"event": "Shot", "at": 105}, {"event": "Play", "team": "Blue", "at": 105}], "shot"),
        ([{"event": "Shot", "team": "Blue", "at": 105}], "opponent_possession"),
        ([{"event": "Faceoff Win", "at": 105}, {"event": "Shot", "at": 106}], "stoppage"),
        ([{"event": "Penalty Taken", "at": 105}], "stoppage"),
        ([{"event": "Penalty Taken", "team": "Blue", "at": 105}], "stoppage"),
        ([{"event": "Shot", "at": 0, "period": 2}], "time_expired"),
        # Later in the log but earlier on the clock.
        ([{"event": "Shot", "at": 40}], "shot"),
        ([{"event": "Play", "team": "Blue", "at": 300}, {"event": "Shot", "at": 101}], "shot"),
        ([{"event": "Play", "team": "Blue", "at": 300}, {"event": "Play", "team": "Blue", "at": 104}], "opponent_possession"),
        ([{"event": "Shot", "at": 300}, {"event": "Goal", "at": 104}], "shot"),
    ]
    built = games(spark, [[{"event": "Play", "team": "Blue"}, {"event": WIN, "at": 100}, *after] for after, _ in cases])
    assert [game[2]["end_reason"] for game in built] == [reason for _, reason in cases]
    for game, (_, reason) in zip(built, cases):
        assert game[2]["led_to_shot"] == (reason == "shot")
        if reason != "shot":
            for c in ("shot_event_id", "seconds_to_shot", "shot_x", "shot_y", "shot_type", "shot_result", "is_goal"):
                assert game[2][c] is None


def test_only_the_first_shot_is_credited(spark):
    rows = [raw_row(1, WIN), raw_row(2, "Shot", at=3, x=180.0, y=20.0, detail=" Wrist "), raw_row(3, "Goal", at=5)]
    got = outcome(spark, rows)[1]
    assert (got["shot_event_id"], got["seconds_to_shot"], got["is_goal"]) == (2, 3, False)
    assert (got["shot_x"], got["shot_y"], got["shot_type"]) == (180.0, 20.0, "Wrist")


def test_padded_shots_do_not_count(spark):
    assert outcome(spark, [raw_row(1, WIN), raw_row(2, " Shot ", at=3)])[1]["end_reason"] == "time_expired"


def test_population_is_offensive_zone_wins(spark):
    rows = [raw_row(1, WIN, x=125.0), raw_row(2, WIN, x=124.0, at=1), raw_row(3, "Takeaway", at=2), raw_row(4, "Shot", at=3)]
    assert sorted(outcome(spark, rows)) == [1, 3]


def test_unknown_clock_sees_nothing_and_is_not_seen(spark):
    rows = [raw_row(1, WIN, clock=None), raw_row(2, "Shot", at=1), raw_row(3, WIN, at=2), raw_row(4, "Shot", clock=None)]
    got = outcome(spark, rows)
    assert (got[1]["end_reason"], got[3]["end_reason"]) == ("time_expired", "time_expired")


def test_window_length_is_a_rule(spark):
    events = build_scratch(raw_table(spark, [raw_row(1, WIN), raw_row(2, "Shot", at=14)])).events
    assert W.fact_puck_wins(events).first()["end_reason"] == "time_expired"
    assert W.fact_puck_wins(events, Rules(window_seconds=15)).first()["end_reason"] == "shot"


def test_one_game_with_most_of_the_events_gives_the_same_wins_when_cut_into_runs(spark):
    kinds = [WIN, "Shot", "Play", "Takeaway", "Faceoff Win", "Dump In/Out", "Goal", WIN, "Penalty Taken", "Zone Entry"]
    rows = [
        raw_row(i, kinds[(i * 7) % 10], team="Red" if (i // 3) % 2 else "Blue", at=min(i, 1200), x=float((i * 37) % 201))
        for i in range(600)
    ]
    events = build_scratch(raw_table(spark, rows)).events
    whole = W.fact_puck_wins(events).collect()
    cut = W.fact_puck_wins(events, limits=Limits(group_rows=50, chunk_rows=32)).collect()
    assert len(whole) > 50
    assert sorted(map(str, whole)) == sorted(map(str, cut))
