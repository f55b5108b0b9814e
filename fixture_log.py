"""A raw play-by-play log derived from the generic `events` table, growing with it.

Pure integer arithmetic on event_id, user_id and value, so any SQL engine gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Events per game, and how far the ids of the planted copies lie above the rest.
EVENTS_PER_GAME = 250
COPY_OFFSET = 1_000_000_000_000


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_log_of(spark.read.parquet(f"{sf_dir}/events.parquet"))


def raw_log_of(events: DataFrame) -> DataFrame:
    number = events.selectExpr(
        "event_id",
        "user_id AS u",
        f"CAST(FLOOR(event_id / {EVENTS_PER_GAME}) AS BIGINT) AS g",
        f"event_id % {EVENTS_PER_GAME} AS i",
        "(event_id * 7919 + user_id * 104729 + CAST(ROUND(value * 100) AS BIGINT) * 31) % 1000003 AS h",
    ).selectExpr(
        "event_id",
        "u",
        "g",
        "h",
        "1 + CAST(FLOOR(i / 84) AS BIGINT) AS p",
        "(i % 84) * 4 + h % 3 AS el",
        "CASE WHEN g % 7 = 6 THEN 'NCAA - ' ELSE 'Olympic (Women) - ' END AS pre",
        "ELT(CAST(g % 4 AS INT) + 1, 'North', 'South', 'East', 'West') AS hn",
        "ELT(CAST((g + 1 + CAST(FLOOR(g / 4) AS BIGINT) % 3) % 4 AS INT) + 1, 'North', 'South', 'East', 'West') AS an",
        "CAST(FLOOR(h / 7) AS BIGINT) % 2 AS side",
        "CAST(FLOOR(h / 11) AS BIGINT) % 20 AS k",
    )
    named = number.selectExpr(
        "*",
        """CASE WHEN k < 6 THEN 'Puck Recovery' WHEN k = 6 THEN 'Takeaway' WHEN k < 10 THEN 'Shot'
                WHEN k = 10 THEN 'Goal' WHEN k < 13 THEN 'Faceoff Win' WHEN k < 15 THEN 'Dump In/Out'
                WHEN k < 17 THEN 'Zone Entry' WHEN k < 19 THEN 'Play' ELSE 'Penalty Taken' END AS ev""",
    )
    rows = named.selectExpr(
        "event_id",
        "CAST(DATE '2018-02-11' + CAST(FLOOR(g / 2) AS INT) AS DATE) AS game_date",
        "pre || hn AS `Home Team`",
        "pre || an AS `Away Team`",
        "p AS `Period`",
        """' ' || LPAD(CAST(CAST(FLOOR((1200 - el) / 60) AS BIGINT) AS STRING), 2, '0') || ':'
               || LPAD(CAST((1200 - el) % 60 AS STRING), 2, '0') AS `Clock`""",
        """CASE WHEN h % 13 = 0 THEN 6 WHEN h % 5 = 0 THEN 4 WHEN h % 59 = 0 THEN NULL ELSE 5 END
               AS `Home Team Skaters`""",
        "CASE WHEN h % 17 = 0 THEN 6 WHEN h % 6 = 0 THEN 4 ELSE 5 END AS `Away Team Skaters`",
        "0 AS `Home Team Goals`",
        "0 AS `Away Team Goals`",
        "CASE WHEN side = 0 THEN pre || hn ELSE pre || an END AS `Team`",
        "CASE WHEN h % 97 = 0 THEN ' Rookie ' || CAST(u AS STRING) ELSE ' Player ' || CAST(u % 12 AS STRING) || ' ' END AS `Player`",
        "CASE WHEN h % 41 = 0 THEN ' ' || ev || ' ' ELSE ev END AS `Event`",
        "CASE WHEN h % 61 = 0 THEN NULL ELSE (h * 3) % 201 END AS `X Coordinate`",
        "CASE WHEN h % 37 = 0 THEN NULL ELSE (h * 5) % 86 END AS `Y Coordinate`",
        """CASE WHEN ev = 'Zone Entry' THEN CASE h % 3 WHEN 0 THEN 'Dumped' WHEN 1 THEN 'Carried' ELSE 'Played' END
                WHEN ev IN ('Shot', 'Goal') THEN ' Snapshot' END AS `Detail 1`""",
        "CASE WHEN ev = 'Shot' THEN 'On Net ' END AS `Detail 2`",
        "h % 2 = 0 AS `Detail 3`",
        "h % 3 = 0 AS `Detail 4`",
        """CASE WHEN ev IN ('Faceoff Win', 'Zone Entry', 'Play') OR (ev = 'Penalty Taken' AND h % 2 = 0)
                THEN 'Player ' || CAST((u + 5) % 12 AS STRING) END AS `Player 2`""",
        "CASE WHEN ev = 'Play' THEN (h * 7) % 201 END AS `X Coordinate 2`",
        "CASE WHEN ev = 'Play' THEN (h * 11) % 86 END AS `Y Coordinate 2`",
    )
    # Some events are logged twice, the second time with a higher id; both come from one scan.
    once, twice = F.array("event_id"), F.array("event_id", F.col("event_id") + COPY_OFFSET)
    return rows.withColumn("event_id", F.explode(F.when(F.col("event_id") % 97 == 0, twice).otherwise(once)))
