"""Hand-made raw rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pressure.sources.schemas import RAW_SCHEMA

SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), *RAW_SCHEMA.fields])
PREFIX = "Olympic (Women) - "
HOME, AWAY = "Red", "Blue"


def raw_row(event_id: int, event: str = "Play", team: str = HOME, **changes) -> dict:
    """One raw row; `at` gives the seconds elapsed in the period."""
    elapsed = changes.pop("at", 0)
    left = 1200 - elapsed
    row = {
        "event_id": event_id,
        "game_date": date(2020, 1, 1),
        "Home Team": PREFIX + HOME,
        "Away Team": PREFIX + AWAY,
        "Period": 1,
        "Clock": f"{left // 60:02d}:{left % 60:02d}",
        "Home Team Skaters": 5,
        "Away Team Skaters": 5,
        "Home Team Goals": 0,
        "Away Team Goals": 0,
        "Team": PREFIX + team,
        "Player": f"{team} One",
        "Event": event,
        "X Coordinate": 150.0,
        "Y Coordinate": 40.0,
        "Detail 1": None,
        "Detail 2": None,
        "Detail 3": None,
        "Detail 4": None,
        "Player 2": None,
        "X Coordinate 2": None,
        "Y Coordinate 2": None,
    }
    named = {
        "x": "X Coordinate", "y": "Y Coordinate", "period": "Period", "clock": "Clock", "player": "Player",
        "player_2": "Player 2", "detail": "Detail 1", "home": "Home Team", "away": "Away Team",
        "home_skaters": "Home Team Skaters", "away_skaters": "Away Team Skaters", "day": "game_date",
        "raw_team": "Team",
    }
    for key, value in changes.items():
        row[named[key]] = value
    return row


def raw_table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    order = SCHEMA.fieldNames()
    return spark.createDataFrame([tuple(row[c] for c in order) for row in rows], SCHEMA)
