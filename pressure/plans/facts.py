"""Clean events -> fact_events: keys in place of names, and one clock for the whole game."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressure.config import RULES, Rules
from pressure.functions import expressions as X
from pressure.sources.schemas import FACT_EVENT_COLUMNS


def game_clock(period: str, elapsed: str, rules: Rules = RULES) -> Column:
    return (F.col(period) - 1) * rules.period_seconds + F.col(elapsed)


def _spread(name: str) -> Column:
    """The name, or a stand-in of the row's own if there is none.

    Most events have no second player. Joined by a null name they would all land in one task;
    the join asks for a known name besides, so a stand-in never matches.
    """
    stand_in = F.concat(F.lit("no player "), F.col("event_id").cast("string"))
    return F.coalesce(F.col(name), stand_in)


def fact_events(
    clean: DataFrame, games: DataFrame, teams: DataFrame, players: DataFrame, rules: Rules = RULES
) -> DataFrame:
    """One row per clean event. Every lookup is a left join: an unknown name gives no key.

    No broadcast is forced. The dimensions are written tables, so Spark knows their size and
    broadcasts those below its threshold; a larger one is joined by shuffle, with adaptive
    skew splitting for a name that holds much of the log.
    """
    actor = teams.select(F.col("team_name").alias("_team"), F.col("team_key").alias("event_team_key"))
    opponent = teams.select(F.col("team_name").alias("_opp"), F.col("team_key").alias("opponent_team_key"))
    first = players.select(
        F.col("player_name").alias("_name_1"),
        F.col("team_name").alias("_team_1"),
        F.col("player_key").alias("event_player_key"),
    )
    second = players.select(
        F.col("player_name").alias("_name_2"),
        F.col("team_name").alias("_team_2"),
        F.col("player_key").alias("event_player2_key"),
    )
    game = games.select(F.col("game_id").alias("_game"), "game_key")
    events = clean.withColumns(
        {
            "game_seconds": game_clock("period", "period_elapsed", rules),
            "_second_team": X.second_player_team("event", "event_team", "opponent", rules),
            "_first_name": _spread("event_player"),
            "_second_name": _spread("player_2"),
        }
    )
    return (
        events.join(actor, F.col("event_team") == F.col("_team"), "left")
        .join(opponent, F.col("opponent") == F.col("_opp"), "left")
        .join(
            first,
            F.col("event_player").isNotNull()
            & (F.col("_first_name") == F.col("_name_1"))
            & (F.col("event_team") == F.col("_team_1")),
            "left",
        )
        .join(
            second,
            F.col("player_2").isNotNull()
            & (F.col("_second_name") == F.col("_name_2"))
            & (F.col("_second_team") == F.col("_team_2")),
            "left",
        )
        .join(game, F.col("game_id") == F.col("_game"), "left")
        .select(*FACT_EVENT_COLUMNS)
    )
