"""Filterable reports over the wins: rates by cell and by type, player table, summary, end reasons.

All reports count wins, so they read `win_counts`: wins counted per acting team and player and
per value of everything a report shows or filters on. Counting comes first and collapses inside
each task; the dimension lookups then join counts, not wins, and no player or team is heavy.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressure.config import END_REASON_LABELS, RULES, Rules
from pressure.functions import expressions as X


@dataclass(frozen=True)
class Filters:
    """Each filter that is set must match; none set means every win."""

    team: str | None = None
    player: str | None = None
    strength: str | None = None
    win_type: str | None = None


@dataclass(frozen=True)
class WinTables:
    """What the reports read: counted wins and the two dimensions they are filtered by."""

    counts: DataFrame
    teams: DataFrame
    players: DataFrame


NO_FILTERS = Filters()


def win_counts(wins: DataFrame, rules: Rules = RULES) -> DataFrame:
    return (
        wins.withColumns(
            {
                "bx": X.grid_bin(F.col("x_coord") - rules.grid_origin_x, rules.grid_cell_x, rules.grid_last_bin),
                "by_": X.grid_bin(F.col("y_coord"), rules.grid_cell_y, rules.grid_last_bin),
            }
        )
        .groupBy(
            "event_team_key", "event_player_key", "strength_state", "win_type", "event", "led_to_shot",
            "is_goal", "seconds_to_shot", "end_reason", "bx", "by_",
        )
        .agg(F.count("*").alias("n"))
    )


def passes(filters: Filters) -> Column:
    """Whether a counted win, with its names, passes the filters."""
    wanted = {
        "team_name": filters.team,
        "player_name": filters.player,
        "strength_state": filters.strength,
        "win_type": filters.win_type,
    }
    passed = F.lit(True)
    for column, value in wanted.items():
        if value is not None:
            passed = passed & (F.col(column) == value)
    return passed


def named(tables: WinTables) -> DataFrame:
    """Counted wins of known teams and players, with their names."""
    teams = tables.teams.select(F.col("team_key").alias("event_team_key"), "team_name")
    players = tables.players.select(
        F.col("player_key").alias("event_player_key"), "player_name", F.col("team_name").alias("player_team")
    )
    return tables.counts.join(teams, "event_team_key").join(players, "event_player_key")


def selected(tables: WinTables, filters: Filters = NO_FILTERS) -> DataFrame:
    """Those that pass the filters; Spark moves each filter to the table that has its column."""
    return named(tables).filter(passes(filters))


def _wins(condition: Column | None = None) -> Column:
    return F.sum("n" if condition is None else F.when(condition, F.col("n")).otherwise(0))


def _rate() -> Column:
    return X.share(_wins(F.col("led_to_shot")), _wins())


def _median_seconds() -> Column:
    """Exact: a shot comes 0 to 10 seconds after the win, so few values are weighed by count."""
    return F.percentile("seconds_to_shot", 0.5, F.col("n"))


def cells(rows: DataFrame, *by: str, rules: Rules = RULES) -> DataFrame:
    """Shot rate per cell of the offensive zone, with the cell centre in rink coordinates."""
    counted = rows.groupBy(*by, "bx", "by_").agg(_wins().alias("n"), _rate().alias("rate"))
    centre_x = rules.grid_origin_x + F.col("bx") * rules.grid_cell_x + rules.grid_cell_x / 2 - rules.grid_centre_x
    centre_y = F.col("by_") * rules.grid_cell_y + rules.grid_cell_y / 2 - rules.grid_centre_y
    return counted.withColumns({"cx": centre_x, "cy": centre_y})


def types(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by, "win_type").agg(
        _median_seconds().alias("med_seconds_to_shot"),
        _wins(F.col("is_goal")).alias("total_goals"),
        _wins().alias("wins"),
        _rate().alias("rate"),
    )


def reasons(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by, "end_reason").agg(_wins().alias("totals"))


def totals(rows: DataFrame, *by: str) -> DataFrame:
    """Without `by` this is one row, also when nothing is selected."""
    goal = F.col("is_goal")

    def count(condition: Column | None = None) -> Column:
        return F.coalesce(_wins(condition), F.lit(0))

    return rows.groupBy(*by).agg(
        count().alias("wins"),
        count(F.col("event") == "Puck Recovery").alias("recoveries"),
        count(F.col("event") == "Takeaway").alias("takeaways"),
        count(goal).alias("goals"),
        count(goal & (F.col("win_type") == "Rebound")).alias("rebound_goals"),
        count(F.col("led_to_shot")).alias("shots"),
        _rate().alias("rate"),
        _median_seconds().alias("med_secs"),
    )


def shot_rate_grid(tables: WinTables, filters: Filters = NO_FILTERS, rules: Rules = RULES) -> DataFrame:
    return cells(selected(tables, filters), rules=rules)


def team_list(tables: WinTables) -> DataFrame:
    return tables.teams.select("team_name").orderBy(F.asc_nulls_last("team_name"))


def player_list(tables: WinTables, team: str | None = None) -> DataFrame:
    """Players with at least one win, of one team if given."""
    players = tables.players if team is None else tables.players.filter(F.col("team_name") == team)
    winners = tables.counts.select(F.col("event_player_key").alias("player_key")).distinct()
    return players.join(winners, "player_key").select("player_name").distinct().orderBy(F.asc_nulls_last("player_name"))


def win_type_list(tables: WinTables) -> DataFrame:
    return tables.counts.select("win_type").distinct().orderBy("win_type")


def table_minimum(filters: Filters, rules: Rules = RULES) -> int:
    """Wins a player needs to be listed. A team filter alone does not lower it."""
    if filters.player is not None:
        return rules.table_minimum_player
    if filters.strength is not None or filters.win_type is not None:
        return rules.table_minimum_filtered
    return rules.table_minimum


def player_table(tables: WinTables, filters: Filters = NO_FILTERS, rules: Rules = RULES) -> DataFrame:
    return (
        selected(tables, filters)
        .groupBy(F.col("player_name").alias("Player"), F.col("player_team").alias("Team"))
        .agg(
            _wins().alias("OZ Wins"),
            _wins(F.col("led_to_shot")).alias("Led To Shot"),
            _rate().alias("Rate"),
        )
        .filter(F.col("OZ Wins") >= table_minimum(filters, rules))
        .orderBy(F.desc("OZ Wins"), "Player", "Team")
    )


def shot_rate_by_win_type(
    tables: WinTables, team: str | None = None, player: str | None = None, strength: str | None = None
) -> DataFrame:
    """Every win type side by side, so there is no filter on win type."""
    return types(selected(tables, Filters(team, player, strength))).orderBy("rate", "win_type")


def summary(tables: WinTables, filters: Filters = NO_FILTERS) -> DataFrame:
    """One row: counts are 0, rate and median unknown, when nothing is selected."""
    return totals(selected(tables, filters))


def end_reasons(tables: WinTables, filters: Filters = NO_FILTERS) -> DataFrame:
    return reasons(selected(tables, filters)).orderBy(F.desc("totals"), "end_reason")


def end_reason_shares(tables: WinTables, filters: Filters = NO_FILTERS) -> DataFrame:
    """End reasons with their label and share; the window runs over at most four rows."""
    total = F.sum("totals").over(Window.partitionBy())
    return end_reasons(tables, filters).withColumns(
        {"label": X.label("end_reason", END_REASON_LABELS), "pct": X.share(F.col("totals"), total)}
    )


def headline(tables: WinTables) -> DataFrame:
    """All wins and their shot rate, before any lookup."""
    return tables.counts.agg(
        F.coalesce(_wins(), F.lit(0)).alias("wins"), F.round(_rate(), 3).alias("shot_rate")
    )


def lowest_volume_player(tables: WinTables, below: int = RULES.table_minimum) -> DataFrame:
    """The player name with the fewest wins, among names with fewer than `below`."""
    names = tables.players.select(F.col("player_key").alias("event_player_key"), "player_name")
    return (
        tables.counts.join(names, "event_player_key")
        .groupBy("player_name")
        .agg(_wins().alias("wins"))
        .filter(F.col("wins") < below)
        .orderBy("wins", "player_name")
        .limit(1)
    )
