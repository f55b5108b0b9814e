"""Raw log -> clean events: one league, plain names, derived state, no copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressure.config import LIMITS, RULES, Limits, Rules
from pressure.functions import expressions as X
from pressure.operators.dedup import first_of_equals
from pressure.operators.ordering import row_numbers
from pressure.sources.schemas import CLEAN_COLUMNS

_GAME = ("game_date", "Home Team", "Away Team")


def kept_events(raw: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Rows of the kept league; the prefix test reaches the file scan."""
    return raw.filter(X.is_kept_league("Home Team", rules))


def game_ids(raw: DataFrame, rules: Rules = RULES, limits: Limits = LIMITS) -> DataFrame:
    """One row per kept game with its rank by date and raw team names.

    The rank is taken over distinct games, not over events, so no task sees the whole log.
    """
    games = kept_events(raw, rules).select(*_GAME).distinct()
    return row_numbers(games, _GAME, "game_id", limits.one_task_rows)


def unique_events(raw: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Trimmed source columns without copies, lowest event_id kept.

    Everything derived later depends on these columns alone, so equal rows here are equal rows
    of the clean table. `is_shot` reads the event text before trimming, as does the clock.
    """
    trimmed = {
        "clock": "Clock",
        "event_player": "Player",
        "event": "Event",
        "detail_1": "Detail 1",
        "detail_2": "Detail 2",
        "player_2": "Player 2",
    }
    renamed = {
        "period": "Period",
        "home_team_skaters": "Home Team Skaters",
        "away_team_skaters": "Away Team Skaters",
        "home_team_goals": "Home Team Goals",
        "away_team_goals": "Away Team Goals",
        "x_coord": "X Coordinate",
        "y_coord": "Y Coordinate",
        "detail_3": "Detail 3",
        "detail_4": "Detail 4",
        "x_coord_2": "X Coordinate 2",
        "y_coord_2": "Y Coordinate 2",
    }
    rows = kept_events(raw, rules).select(
        "event_id",
        *_GAME,
        X.team_name("Team", rules).alias("event_team"),
        X.clock_to_seconds("Clock").alias("clock_seconds"),
        X.flag(F.col("Event").isin(*rules.shot_events)).alias("is_shot"),
        *[F.trim(F.col(source)).alias(name) for name, source in trimmed.items()],
        *[F.col(source).alias(name) for name, source in renamed.items()],
    )
    return first_of_equals(rows, "event_id")


def with_game_id(rows: DataFrame, games: DataFrame) -> DataFrame:
    """Looks the game up by date and raw names; an unknown date or name matches itself."""
    names = {c: f"_{c}" for c in _GAME}
    known = games.withColumnsRenamed(names)
    match = [F.col(c).eqNullSafe(F.col(key)) for c, key in names.items()]
    return rows.join(known, match[0] & match[1] & match[2], "left").drop(*names.values())


def clean_events(raw: DataFrame, rules: Rules = RULES, limits: Limits = LIMITS) -> DataFrame:
    rows = with_game_id(unique_events(raw, rules), game_ids(raw, rules, limits))
    return (
        rows.withColumns(
            {
                "league": F.lit(rules.kept_league),
                "home_team": X.team_name("Home Team", rules),
                "away_team": X.team_name("Away Team", rules),
                "period_elapsed": F.lit(rules.period_seconds) - F.col("clock_seconds"),
                "zone": X.zone("x_coord", rules),
            }
        )
        .withColumn("is_home", F.col("event_team") == F.col("home_team"))
        .withColumns(
            {
                "opponent": X.from_own_side("is_home", "away_team", "home_team"),
                "team_skaters": X.from_own_side("is_home", "home_team_skaters", "away_team_skaters"),
                "opp_skaters": X.from_own_side("is_home", "away_team_skaters", "home_team_skaters"),
            }
        )
        .withColumns(
            {
                "strength_state": X.strength("team_skaters", "opp_skaters", rules),
                "skater_state": X.skaters_label("team_skaters", "opp_skaters"),
            }
        )
        .select(*CLEAN_COLUMNS)
    )
