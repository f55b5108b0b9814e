"""Quality reports over the built tables and over the reports made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressure.config import END_REASON_LABELS, RULES, STRENGTHS, WIN_TYPES, Rules
from pressure.operators import quality as Q
from pressure.plans import marts as M
from pressure.plans.build import Layers
from pressure.plans.clean import kept_events, unique_events
from pressure.sources.scratch import keep


def table_checks(layers: Layers, rules: Rules = RULES) -> DataFrame:
    """Grain, keys, ranges and label domains of every table."""
    clean, events, wins = layers.clean, layers.events, layers.wins
    led, shot, seconds = F.col("led_to_shot"), F.col("shot_event_id"), F.col("seconds_to_shot")
    elapsed, x = F.col("period_elapsed"), F.col("x_coord")
    own, other = F.col("event_team_key"), F.col("opponent_team_key")
    games = kept_events(layers.raw, rules).select("game_date", "Home Team", "Away Team").distinct()
    none, n = F.lit(0), F.count("*")

    def rows(broken: dict[str, Column]) -> Q.Counts:
        return {name: (n, F.count_if(condition)) for name, condition in broken.items()}

    copies = "clean rows are the kept rows without copies"
    one_game = "one game per date and pair of teams"
    one_win = "one win per offensive-zone recovery or takeaway"
    one_fact = "one fact per clean event"
    is_win = (F.col("zone") == "OZ") & F.col("event").isin(*rules.win_events)
    of_clean = rows(
        {"elapsed time inside the period": elapsed.isNull() | (elapsed < 0) | (elapsed > rules.period_seconds)}
    )
    of_events = rows(
        {
            "game key present": F.col("game_key").isNull(),
            "team key present": own.isNull(),
            "opponent key present": other.isNull(),
            "player key present": F.col("event_player_key").isNull(),
            "team is not its opponent": own == other,
        }
    )
    of_wins = rows(
        {
            "win lies in the offensive zone": x.isNull() | (x < rules.offensive_from_x),
            "credited shot has an id": led & shot.isNull(),
            "no shot id without a credited shot": ~led & shot.isNotNull(),
            "shot falls inside the window": led & (seconds.isNull() | (seconds < 0) | (seconds > rules.window_seconds)),
            "end reason agrees with the shot flag": ~(F.col("end_reason") == "shot").eqNullSafe(led),
            "win event known": Q.outside("event", rules.win_events),
            "win type known": Q.outside("win_type", WIN_TYPES),
            "end reason known": Q.outside("end_reason", list(END_REASON_LABELS)),
        }
    )
    return Q.report(
        [
            Q.tally(
                [
                    (clean, {copies: (n, n), one_win: (none, -F.count_if(is_win)), one_fact: (none, -n), **of_clean}),
                    (unique_events(layers.raw, rules), {copies: (none, -n)}),
                    (layers.games, {one_game: (n, n)}),
                    (games, {one_game: (none, -n)}),
                    (events, {one_fact: (n, n), **of_events}),
                    (wins, {one_win: (n, n), **of_wins}),
                ]
            ),
            Q.unique_rows("clean rows differ in more than the id", clean, "event_id"),
            Q.unique_key("one row per player and team", layers.players, ["player_name", "team_name"]),
            Q.unique_key("one row per team", layers.teams, ["team_name"]),
            Q.distinct_ids("one row per win event", wins, "event_id"),
            Q.null_parity(
                "second player key present with second player",
                events, "event_player2_key", clean, "player_2", "event_id",
            ),
            Q.accepted_values("strength known", clean, "strength_state", STRENGTHS),
        ]
    )


def known_total_checks(layers: Layers, rows: dict[str, int], rate: float, totals: dict[str, int]) -> DataFrame:
    """A load whose numbers are known: rows per table, the headline rate, and summary totals."""
    tables = vars(layers)
    summary = M.summary(layers.win_tables)
    return Q.report(
        [Q.expected_rows(f"rows of {name}", tables[name], n) for name, n in rows.items()]
        + [
            Q.rows_where(
                M.headline(layers.win_tables),
                {"headline shot rate": ~F.col("shot_rate").eqNullSafe(F.lit(rate))},
            ),
            Q.rows_where(summary, {f"summary {name}": F.col(name) != n for name, n in totals.items()}),
        ]
    )


def filter_name(filters: M.Filters) -> str:
    given = {k: v for k, v in vars(filters).items() if v is not None}
    return ", ".join(f"{k}={v}" for k, v in given.items()) or "no filter"


def filter_totals(tables: M.WinTables, rules: Rules = RULES) -> DataFrame:
    """Wins per value of every filter: all of them, and those that the parts of each report count.

    The one read of the counted wins. All checks of all filter sets are sums of its rows.
    """
    last = rules.grid_last_bin
    led = F.coalesce(F.col("led_to_shot"), F.lit(False))
    counted = {
        "wins": F.lit(True),
        "shots": led,
        "cell_wins": F.col("bx").between(0, last) & F.col("by_").between(0, last),
        "type_wins": F.col("win_type").isin(*WIN_TYPES),
        "reason_wins": F.col("end_reason").isin(*END_REASON_LABELS),
        "reason_shots": F.col("end_reason") == "shot",
    }
    sums = [F.sum(F.when(condition, F.col("n")).otherwise(0)).alias(name) for name, condition in counted.items()]
    rows = M.named(tables).groupBy("team_name", "player_name", "player_team", "strength_state", "win_type").agg(*sums)
    return keep(rows, "filter-totals")


def _by_set(totals: DataFrame, sets: list[M.Filters], *by: Column) -> tuple[DataFrame, DataFrame]:
    """(a row per filter set, the totals summed by the sets that each row passes): `set` numbers the sets."""
    numbers = F.array(*[F.lit(i) for i in range(len(sets))])
    passed = F.array_compact(F.array(*[F.when(M.passes(f), F.lit(i)) for i, f in enumerate(sets)]))
    names = F.array(*[F.lit(filter_name(f)) for f in sets])
    every = totals.sparkSession.range(1).select(F.explode(numbers).alias("set")).withColumn("filters", names[F.col("set")])
    sums = [F.sum(c).alias(c) for c in ("wins", "shots", "cell_wins", "type_wins", "reason_wins", "reason_shots")]
    return every, totals.withColumn("set", F.explode(passed)).groupBy("set", *by).agg(*sums)


def breakdown_checks(totals: DataFrame, filter_sets: list[M.Filters]) -> DataFrame:
    """Per filter set: do the cells of the grid, the win types and the end reasons that are shown add up to the summary?

    A set that selects nothing stays in the report with totals of 0.
    """
    every, sums = _by_set(totals, filter_sets)

    def result(check: str, total: str, parts: str) -> Column:
        whole, summed = F.coalesce(total, F.lit(0)), F.coalesce(parts, F.lit(0))
        return F.struct(
            F.concat(F.lit(f"{check}: "), "filters").alias("check"),
            whole.alias("checked"),
            F.abs(whole - summed).alias("violations"),
        )

    return every.join(sums, "set", "left").select(
        F.inline(
            F.array(
                result("cells add up", "wins", "cell_wins"),
                result("win types add up", "wins", "type_wins"),
                result("end reasons add up", "wins", "reason_wins"),
                result("shot end reason is the shots", "shots", "reason_shots"),
            )
        )
    )


def win_type_checks(totals: DataFrame) -> DataFrame:
    """Every row of the comparison is a type that a summary can be filtered to."""
    return totals.groupBy("win_type").agg(F.sum("wins").alias("checked")).select(
        F.concat(F.lit("win type agrees: "), "win_type").alias("check"),
        "checked",
        Q.outside("win_type", WIN_TYPES).cast("long").alias("violations"),
    )


def table_minimum_checks(
    totals: DataFrame, minimum_sets: list[tuple[M.Filters, int]], rules: Rules = RULES
) -> DataFrame:
    """The table lists exactly the players who have the wins that are asked for; `minimum_sets` says how many that is."""
    sets = [f for f, _ in minimum_sets]
    listed_from = F.array(*[F.lit(M.table_minimum(f, rules)) for f in sets])[F.col("set")]
    asked_from = F.array(*[F.lit(n) for _, n in minimum_sets])[F.col("set")]
    every, sums = _by_set(totals, sets, F.col("player_name"), F.col("player_team"))
    listed, due = F.col("wins") >= listed_from, F.col("wins") >= asked_from
    counted = sums.groupBy("set").agg(F.count_if(listed).alias("checked"), F.count_if(listed != due).alias("violations"))
    return every.join(counted, "set", "left").select(
        F.concat(F.lit("table minimum: "), "filters").alias("check"),
        F.coalesce("checked", F.lit(0)).alias("checked"),
        F.coalesce("violations", F.lit(0)).alias("violations"),
    )


def report_checks(
    tables: M.WinTables,
    filter_sets: list[M.Filters],
    minimum_sets: list[tuple[M.Filters, int]],
    rules: Rules = RULES,
) -> DataFrame:
    totals = filter_totals(tables, rules)
    return Q.report(
        [
            breakdown_checks(totals, filter_sets),
            win_type_checks(totals),
            table_minimum_checks(totals, minimum_sets, rules),
        ]
    )
