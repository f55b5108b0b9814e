"""Clean events -> game, team and player dimensions with integer keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressure.config import LIMITS, RULES, Limits, Rules
from pressure.functions import expressions as X
from pressure.operators.ordering import row_numbers
from pressure.sources.schemas import DIM_GAME_COLUMNS, DIM_PLAYER_COLUMNS, DIM_TEAM_COLUMNS


def dim_game(clean: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Score and winner per game; a tie was settled by a shootout."""
    goal = F.col("event") == "Goal"
    games = clean.groupBy("game_id", "game_date", "league", "home_team", "away_team").agg(
        F.count_if(goal & F.col("is_home")).alias("home_score"),
        F.count_if(goal & ~F.col("is_home")).alias("away_score"),
    )
    home, away = F.col("home_score"), F.col("away_score")
    scored = games.withColumns(
        {
            "total_game_goals": home + away,
            "winner": F.when(home > away, F.col("home_team"))
            .when(away > home, F.col("away_team"))
            .otherwise("Shootout"),
        }
    )
    return row_numbers(scored, ["game_id"], "game_key", limits.one_task_rows).select(*DIM_GAME_COLUMNS)


def dim_team(clean: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Teams that act in at least one event."""
    teams = clean.select(F.col("event_team").alias("team_name"), "league").distinct()
    return row_numbers(teams, ["team_name", "league"], "team_key", limits.one_task_rows).select(*DIM_TEAM_COLUMNS)


def dim_player(clean: DataFrame, rules: Rules = RULES, limits: Limits = LIMITS) -> DataFrame:
    """Players with the team they act for, as first or second player of an event.

    Both roles come out of one scan; copies collapse in each task before the shuffle.
    """
    second_team = X.second_player_team("event", "event_team", "opponent", rules)
    first = F.struct(F.col("event_player").alias("player_name"), F.col("event_team").alias("team_name"))
    second = F.struct(F.col("player_2").alias("player_name"), second_team.alias("team_name"))
    roles = F.when(F.col("player_2").isNotNull(), F.array(first, second)).otherwise(F.array(first))
    players = clean.select("league", F.inline(roles)).distinct()
    order = ["team_name", "player_name", "league"]
    return row_numbers(players, order, "player_key", limits.one_task_rows).select(*DIM_PLAYER_COLUMNS)
