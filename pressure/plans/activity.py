"""The sequence operators on the generic `events` table: one user's events in id order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressure.config import LIMITS, Limits
from pressure.operators.sequence import first_outcome, previous_row, split_by_size

_MICROS = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))"
DAY_MICROS = 86_400 * 1_000_000


def timed(events: DataFrame) -> DataFrame:
    return events.select("user_id", "event_id", "event_type", "value", F.expr(_MICROS).alias("at"))


def previous_event(events: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Every event with the type of the user's event before it and the time between them."""

    def job(rows: DataFrame, run: str | None) -> DataFrame:
        return previous_row(rows, ["user_id"], "event_id", ["event_type", "at"], run)

    return split_by_size(timed(events), ["user_id"], "event_id", job, limits).select(
        "event_id",
        "user_id",
        "event_type",
        F.col("previous.event_type").alias("previous_event_type"),
        (F.col("at") - F.col("previous.at")).alias("micros_since_previous"),
    )


def click_outcomes(events: DataFrame, horizon: int = DAY_MICROS, limits: Limits = LIMITS) -> DataFrame:
    """After each click: did the same user buy within the horizon, before running into an error?"""

    def job(rows: DataFrame, run: str | None) -> DataFrame:
        return first_outcome(
            rows,
            by=["user_id"],
            order="event_id",
            time="at",
            side=F.lit(0),
            anchor=F.col("event_type") == "click",
            success=F.col("event_type") == "purchase",
            stop=F.col("event_type") == "error",
            horizon=horizon,
            payload=["event_type", "value"],
            run=run,
        )

    return split_by_size(timed(events), ["user_id"], "event_id", job, limits).select(
        "event_id",
        "user_id",
        F.col("end.event_id").alias("error_event_id"),
        F.col("hit.event_id").alias("purchase_event_id"),
        F.col("hit.value").alias("purchase_value"),
        (F.col("hit.at") - F.col("at")).alias("micros_to_purchase"),
        F.when(F.col("hit").isNotNull(), "purchase")
        .when(F.col("end").isNotNull(), "error")
        .otherwise("neither")
        .alias("outcome"),
    )
