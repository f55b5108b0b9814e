"""fact_events -> fact_puck_wins: how each offensive-zone win came about and what it led to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressure.config import LIMITS, RULES, Limits, Rules
from pressure.operators.sequence import Laid, first_outcome, previous_row, split_by_size
from pressure.sources.schemas import FACT_WIN_COLUMNS, WIN_COLUMNS

_PREVIOUS = ("event", "event_team_key", "detail_1", "period")


def with_previous(facts: DataFrame, run: str | None) -> DataFrame:
    """The event just before, in any zone and any period of the same game."""
    return previous_row(facts, ["game_key"], "event_id", _PREVIOUS, run).select(
        "*",
        *[F.col(f"previous.{c}").alias(f"previous_{c}") for c in _PREVIOUS],
    ).drop("previous")


def win_type() -> Column:
    """The first rule that holds names the win. Rules read the event and the one before it."""
    same_team = F.col("previous_event_team_key") == F.col("event_team_key")
    before = F.col("previous_event")
    dumped = (before == "Dump In/Out") | ((before == "Zone Entry") & (F.col("previous_detail_1") == "Dumped"))
    from_opponent = F.col("previous_event_team_key") == F.col("opponent_team_key")
    return (
        F.when(F.col("previous_period") != F.col("period"), "Other / Loose Puck")
        .when(same_team & (before == "Shot"), "Rebound")
        .when(same_team & (before == "Faceoff Win"), "Faceoff")
        .when(same_team & dumped, "Forecheck Retrieval")
        .when((F.col("event") == "Takeaway") | from_opponent, "Forced Turnover")
        .otherwise("Support")
    )


def is_win(rules: Rules = RULES) -> Column:
    return F.col("event").isin(*rules.win_events) & (F.col("zone") == "OZ")


def events_lagged(facts: DataFrame | Laid, limits: Limits = LIMITS) -> DataFrame:
    return split_by_size(facts, ["game_key"], "event_id", with_previous, limits)


def wins_typed(facts: DataFrame | Laid, rules: Rules = RULES, limits: Limits = LIMITS) -> DataFrame:
    """The win population with its type; the filter comes after the look back."""
    lagged = events_lagged(facts, limits)
    return lagged.filter(is_win(rules)).withColumn("win_type", win_type()).select(*WIN_COLUMNS)


def win_outcomes(facts: DataFrame | Laid, rules: Rules = RULES, limits: Limits = LIMITS) -> DataFrame:
    """Wins with their type, the event that closed the window (`end`) and the credited shot (`hit`)."""

    def job(rows: DataFrame, run: str | None) -> DataFrame:
        lagged = with_previous(rows, run).withColumn("win_type", F.when(is_win(rules), win_type()))
        return first_outcome(
            lagged,
            by=["game_key", "period"],
            order="event_id",
            time="game_seconds",
            side=F.col("event_team_key"),
            anchor=is_win(rules),
            success=F.col("is_shot") == 1,
            stop=F.col("event").isin(*rules.stoppage_events),
            horizon=rules.window_seconds,
            payload=["event", "x_coord", "y_coord", "detail_1", "detail_2"],
            run=run,
        )

    used = [
        "game_key", "event_id", "period", "game_seconds", "event", "zone", "is_shot", "event_team_key",
        "opponent_team_key", "event_player_key", "x_coord", "y_coord", "detail_1", "detail_2",
        "strength_state", "skater_state",
    ]
    return split_by_size(facts.select(*used), ["game_key"], "event_id", job, limits)


def fact_puck_wins(facts: DataFrame | Laid, rules: Rules = RULES, limits: Limits = LIMITS) -> DataFrame:
    led = F.col("hit").isNotNull()
    ended_by = F.col("end.event")
    return (
        win_outcomes(facts, rules, limits)
        .withColumns(
            {
                "led_to_shot": led,
                "shot_event_id": F.col("hit.event_id"),
                "seconds_to_shot": F.col("hit.game_seconds") - F.col("game_seconds"),
                "shot_x": F.col("hit.x_coord"),
                "shot_y": F.col("hit.y_coord"),
                "shot_type": F.col("hit.detail_1"),
                "shot_result": F.col("hit.detail_2"),
                "is_goal": F.col("hit.event") == "Goal",
                "end_reason": F.when(led, "shot")
                .when(ended_by.isin(*rules.stoppage_events), "stoppage")
                .when(F.col("end").isNotNull(), "opponent_possession")
                .otherwise("time_expired"),
            }
        )
        .select(*FACT_WIN_COLUMNS)
    )


def first_following(facts: DataFrame | Laid, rules: Rules = RULES, limits: Limits = LIMITS) -> DataFrame:
    """Per win, the first later event of any kind inside its window."""
    return _first_in_window(facts, ["game_key", "period"], F.lit(True), rules, limits)


def first_own_shot(facts: DataFrame | Laid, rules: Rules = RULES, limits: Limits = LIMITS) -> DataFrame:
    """Per win, the first later shot of the same team inside its window, whatever came between."""
    own = F.col("is_shot") == 1
    return _first_in_window(facts, ["game_key", "period", "event_team_key"], own, rules, limits)


def _first_in_window(facts: DataFrame | Laid, by: list[str], wanted: Column, rules: Rules, limits: Limits) -> DataFrame:
    rows = facts.select("game_key", "period", "event_team_key", "event_id", "game_seconds", "event", "zone", "is_shot")

    def job(part: DataFrame, run: str | None) -> DataFrame:
        return first_outcome(
            part, by, "event_id", "game_seconds", F.lit(0), is_win(rules), wanted, F.lit(False),
            rules.window_seconds, ["event", "event_team_key"], run,
        )

    return split_by_size(rows, ["game_key"], "event_id", job, limits)
