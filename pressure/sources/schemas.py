"""Column layouts: the raw file and the tables derived from it."""

from __future__ import annotations

from pyspark.sql import types as T

# The clock is text: a type guess would read 20:00 as a time of day.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("game_date", T.DateType()),
        T.StructField("Home Team", T.StringType()),
        T.StructField("Away Team", T.StringType()),
        T.StructField("Period", T.LongType()),
        T.StructField("Clock", T.StringType()),
        T.StructField("Home Team Skaters", T.LongType()),
        T.StructField("Away Team Skaters", T.LongType()),
        T.StructField("Home Team Goals", T.LongType()),
        T.StructField("Away Team Goals", T.LongType()),
        T.StructField("Team", T.StringType()),
        T.StructField("Player", T.StringType()),
        T.StructField("Event", T.StringType()),
        T.StructField("X Coordinate", T.DoubleType()),
        T.StructField("Y Coordinate", T.DoubleType()),
        T.StructField("Detail 1", T.StringType()),
        T.StructField("Detail 2", T.StringType()),
        T.StructField("Detail 3", T.StringType()),
        T.StructField("Detail 4", T.StringType()),
        T.StructField("Player 2", T.StringType()),
        T.StructField("X Coordinate 2", T.DoubleType()),
        T.StructField("Y Coordinate 2", T.DoubleType()),
    ]
)
RAW_COLUMNS = RAW_SCHEMA.fieldNames()

# The columns of each table, in order.
CLEAN_COLUMNS = (
    "event_id", "game_id", "game_date", "league", "home_team", "away_team", "event_team", "period", "clock",
    "clock_seconds", "period_elapsed", "home_team_skaters", "away_team_skaters", "home_team_goals",
    "away_team_goals", "event_player", "event", "x_coord", "y_coord", "detail_1", "detail_2", "detail_3",
    "detail_4", "player_2", "x_coord_2", "y_coord_2", "is_home", "opponent", "team_skaters", "opp_skaters",
    "strength_state", "skater_state", "zone", "is_shot",
)
DIM_GAME_COLUMNS = (
    "game_key", "game_id", "game_date", "league", "home_team", "away_team", "home_score", "away_score",
    "total_game_goals", "winner",
)
DIM_TEAM_COLUMNS = (
    "team_key", "team_name", "league",
)
DIM_PLAYER_COLUMNS = (
    "player_key", "player_name", "team_name", "league",
)
FACT_EVENT_COLUMNS = (
    "event_id", "period", "clock_seconds", "period_elapsed", "event", "zone", "x_coord", "y_coord",
    "x_coord_2", "y_coord_2", "detail_1", "detail_2", "detail_3", "detail_4", "is_home", "team_skaters",
    "opp_skaters", "strength_state", "skater_state", "is_shot", "game_seconds", "event_team_key",
    "opponent_team_key", "event_player_key", "event_player2_key", "game_key",
)
WIN_COLUMNS = (
    "win_type", "previous_event_team_key", "previous_event", "previous_detail_1", "event_team_key",
    "game_key", "period", "x_coord", "y_coord", "game_seconds", "event_id", "event", "opponent_team_key",
    "event_player_key", "strength_state", "skater_state",
)
FACT_WIN_COLUMNS = (
    *WIN_COLUMNS,
    "led_to_shot", "shot_event_id", "seconds_to_shot", "shot_x", "shot_y", "shot_type", "shot_result",
    "is_goal", "end_reason",
)
