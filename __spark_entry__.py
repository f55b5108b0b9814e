
from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce
from pathlib import Path
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HERE = str(Path(__file__).resolve().parent)
if HERE not in sys.path:
    sys.path.insert(0, HERE)

import check_sql
from fixture_log import raw_log
from pressure.config import Limits
from pressure.functions import expressions as X
from pressure.operators import profile as P
from pressure.operators.dedup import extra_copies
from pressure.plans import activity, checks, clean, dims, marts, wins
from pressure.plans.build import STAGED, TABLES, Layers, build_all, build_if_absent, build_scratch, store_events
from pressure.plans.profiling import COORDINATES, profile_folder
from pressure.sources.csv_log import ingest_events
from pressure.sources import builds
from pressure.sources.scratch import file_state, keep, new_folder
from pressure.sources.tables import forget

Query = Callable[[SparkSession, str], DataFrame]

# Low limits send ordinary data down the paths meant for very large groups and tables.
SMALL = Limits(group_rows=100, chunk_rows=64, one_task_rows=16)

_BUILT: dict[tuple, Layers] = {}


def _input_key(spark: SparkSession, sf_dir: str) -> tuple:
    return (spark.sparkContext.applicationId, file_state(spark, f"{sf_dir}/events.parquet"))


def use_layers(spark: SparkSession, sf_dir: str, built: Layers) -> None:
    """Answers queries on this folder from tables that are already built."""
    _BUILT[_input_key(spark, sf_dir)] = built


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    """The tables built from this folder: built once per session, again if the input changes."""
    key = _input_key(spark, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = build_scratch(raw_log(spark, sf_dir))
    return _BUILT[key]


def _importable(query: Query) -> Query:
    """Python workers of a local session find the package whatever folder they start in; a cluster has it installed."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
        if HERE not in paths:
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([HERE, *filter(None, paths)])
        return query(spark, sf_dir)

    return run


def _module(name: str):
    """An optional module of the training-data part; None if it cannot be imported."""
    try:
        return importlib.import_module(name)
    except ImportError:
        return None


def _llm() -> dict[str, Query]:
    """The queries of subpackage llm and of the corpus pipeline, as far as these are there."""
    found: dict[str, Query] = {}
    if of_llm := _module("pressure.llm.queries"):
        found |= of_llm.queries()
    if pipeline := _module("corpus_pipeline"):
        found["pipeline"] = pipeline.run
    return {name: _importable(query) for name, query in found.items()}


def _llm_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    if of_llm := _module("pressure.llm.queries"):
        found |= of_llm.oracle_sql()
    if (pipeline := _module("corpus_pipeline")) and pipeline.ORACLE_SQL:
        found["pipeline"] = pipeline.ORACLE_SQL
    return found


def entry(spark: SparkSession) -> DataFrame:
    return queries()["shot_rate_by_win_type"](spark, "/root/testdata/sf0.001")


def _on_raw(job: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: job(raw_log(spark, sf_dir))


def _on_layers(job: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, sf_dir: job(layers(spark, sf_dir))


def _on_wins(job: Callable[..., DataFrame], **filters: str) -> Query:
    return lambda spark, sf_dir: job(layers(spark, sf_dir).win_tables, marts.Filters(**filters))


def _on_users(job: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: job(spark.read.parquet(f"{sf_dir}/events.parquet"))


PLAIN_CSV = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _as_csv(spark: SparkSession, sf_dir: str) -> str:
    """Writes the raw log as CSV files in id order; returns their folder."""
    folder = new_folder(spark, "csv")
    raw_log(spark, sf_dir).orderBy("event_id").drop("event_id").write.options(**PLAIN_CSV).csv(folder)
    return folder


def _through_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_events(spark, _as_csv(spark, sf_dir))


def _in_order(log: DataFrame, *order: str) -> DataFrame:
    """The log sorted by other tasks than those that read it: one file per sorted range, read range after range.

    So a task that writes one file of it holds no rows. There are no more ranges than a shuffle has.
    """
    ranges = keep(log.orderBy(*order), "ordered")
    files = sorted(unquote(file) for file in ranges.inputFiles())  # named by their place in the order
    return reduce(DataFrame.unionAll, [log.sparkSession.read.schema(ranges.schema).parquet(file) for file in files])


def _quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with line breaks, quotes and commas inside quotes, in one file that is read in many blocks."""
    folder = new_folder(spark, "csv")
    broken = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit('two\nlines, "'), F.col("Event"), F.lit('"\n\n')))
    log = raw_log(spark, sf_dir).withColumn("Detail 1", F.coalesce(broken, F.col("Detail 1")))
    _in_order(log, "event_id").drop("event_id").coalesce(1).write.options(**PLAIN_CSV, escape='"').csv(folder)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        return ingest_events(spark, folder, multi_line=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def _catalog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The build a user runs, from CSV files into catalog tables: rows of each."""
    build_all(spark, _as_csv(spark, sf_dir), new_folder(spark, "tables"))
    names = (STAGED, *TABLES)
    counted = [spark.table(name).agg(F.lit(name).alias("table"), F.count("*").alias("rows")) for name in names]
    return reduce(DataFrame.unionByName, counted)


def _catalog_reopened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary from tables that were built before, dropped from the catalog, and found again under their root."""
    root = new_folder(spark, "tables")
    build_all(spark, _as_csv(spark, sf_dir), root)
    forget(spark, (STAGED, *TABLES))
    return marts.summary(build_if_absent(spark, "/nowhere", root).win_tables)


def _catalog_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each table after a second build, of a third of the log, was lost before its last table."""
    root = new_folder(spark, "tables")
    built = build_all(spark, _as_csv(spark, sf_dir), root)
    lost = builds.start(root)
    raw = builds.write(lost, built.raw.filter(F.col("event_id") % 3 == 0), STAGED)
    builds.write(lost, clean.clean_events(raw), "clean.events")
    found = build_if_absent(spark, "/nowhere", root)
    tables = (found.raw, found.clean, found.games, found.teams, found.players, found.events, found.wins, found.counts)
    counted = [df.agg(F.lit(name).alias("table"), F.count("*").alias("rows")) for name, df in zip((STAGED, *TABLES), tables, strict=True)]
    return reduce(DataFrame.unionByName, counted)


def _cut_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wins from facts that are stored with nearly all games cut into runs."""
    t = layers(spark, sf_dir)
    build = builds.start(new_folder(spark, "layers"))
    return wins.fact_puck_wins(store_events(build, t.clean, t.games, t.events, SMALL), limits=SMALL)


def _file_profile(part: str) -> Query:
    """The profile of each of several files, all of one name, in folders of their own."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = new_folder(spark, "files")
        log = raw_log(spark, sf_dir).withColumn("part", F.col("event_id") % 3)
        ordered = _in_order(log, "part", "event_id")

        def write(number: int | None) -> None:
            rows = ordered.where(F.col("part").eqNullSafe(F.lit(number))).drop("event_id", "part")
            rows.coalesce(1).write.options(**PLAIN_CSV).csv(f"{folder}/part={number}")

        numbers = [r["part"] for r in ordered.select("part").distinct().collect()]  # three or so
        with ThreadPoolExecutor(len(numbers) or 1) as pool:
            list(pool.map(write, numbers))
        rows = profile_folder(spark, f"{folder}/part=*")[part]
        number = F.regexp_extract("file", "part=([0-9]+)", 1).cast("int")
        return rows.withColumn("part", number).drop("file")

    return run


def _leagues(raw: DataFrame) -> DataFrame:
    league = F.when(X.is_kept_league("Home Team"), "Olympic").otherwise("NCAA")
    return raw.groupBy(league.alias("league")).agg(F.count("*").alias("n"))


def _removed(tables: Layers) -> DataFrame:
    before = clean.kept_events(tables.raw).select(F.lit(1).alias("before"), F.lit(0).alias("after"))
    after = tables.clean.select(F.lit(0).alias("before"), F.lit(1).alias("after"))
    return (
        before.unionAll(after)
        .agg(F.sum("before").alias("rows_before"), F.sum("after").alias("rows_after"))
        .withColumn("removed", F.col("rows_before") - F.col("rows_after"))
    )


def _counts(*columns: str) -> Query:
    return _on_layers(lambda t: t.clean.groupBy(*columns).agg(F.count("*").alias("n")))


def _second_players(tables: Layers) -> DataFrame:
    return tables.events.groupBy("event").agg(
        F.count("*").alias("n"),
        F.count("event_player2_key").alias("with_second_player"),
        F.count_distinct("event_player2_key").alias("second_players"),
    )


def _found(df: DataFrame, struct: str, names: dict[str, str]) -> DataFrame:
    return df.select(
        "event_id",
        *[F.col(f"{struct}.{field}").alias(name) for field, name in names.items() if field != "game_seconds"],
        *[
            (F.col(f"{struct}.game_seconds") - F.col("game_seconds")).alias(name)
            for field, name in names.items()
            if field == "game_seconds"
        ],
    )


def _first_event(tables: Layers) -> DataFrame:
    names = {
        "event_id": "following_event_id",
        "event": "following_event",
        "event_team_key": "following_team_key",
        "game_seconds": "seconds_since_win",
    }
    return _found(wins.first_following(tables.events_by_game), "hit", names)


def _first_end(tables: Layers) -> DataFrame:
    names = {"event_id": "end_event_id", "event": "end_event", "game_seconds": "seconds_to_end"}
    return _found(wins.win_outcomes(tables.events_by_game), "end", names)


def _first_shot(tables: Layers) -> DataFrame:
    names = {"event_id": "shot_event_id", "event": "shot_event", "game_seconds": "seconds_to_shot"}
    return _found(wins.first_own_shot(tables.events_by_game), "hit", names)


def _outcome(tables: Layers) -> DataFrame:
    return wins.win_outcomes(tables.events_by_game).select(
        F.col("event_id").alias("win_event_id"),
        F.col("end.event_id").alias("end_event_id"),
        F.col("hit").isNotNull().alias("led_to_shot"),
        F.col("hit.event_id").alias("shot_event_id"),
    )


def _late(tables: Layers) -> DataFrame:
    """Facts whose clocks run backwards now and then."""
    return tables.events.withColumn("game_seconds", F.col("game_seconds") - (F.col("event_id") * 13) % 29)


def _filter_sets() -> list[marts.Filters]:
    return [marts.Filters(**f) for f in check_sql.FILTER_SETS]


def _report_checks(tables: Layers) -> DataFrame:
    minimum_sets = [(marts.Filters(**f), n) for f, n in check_sql.MINIMUM_SETS]
    return checks.report_checks(tables.win_tables, _filter_sets(), minimum_sets)


def _broken_reports(tables: Layers) -> DataFrame:
    """The same of wins with faults, and with minimums that are not those of the table."""
    minimum_sets = [(marts.Filters(**f), n + 3) for f, n in check_sql.MINIMUM_SETS]
    broken = marts.WinTables(marts.win_counts(_broken(tables).wins), tables.teams, tables.players)
    return checks.report_checks(broken, _filter_sets(), minimum_sets)


def _broken(tables: Layers) -> Layers:
    """The tables with faults of every kind that the checks look for."""
    at = F.col("event_id")

    def fault(period: int, rest: int, wrong: object, column: str) -> Column:
        return F.when(at % period == rest, wrong).otherwise(F.col(column))

    clean = tables.clean.withColumns(
        {
            "strength_state": fault(40, 2, F.lit("XX"), "strength_state"),
            "period_elapsed": fault(30, 3, F.lit(-1), "period_elapsed"),
        }
    )
    copies = clean.filter(at % 50 == 1).withColumn("event_id", at + 10_000_000_000_000)
    team = F.when(at % 70 == 5, F.col("opponent_team_key")).when(at % 70 == 6, None).otherwise(F.col("event_team_key"))
    events = tables.events.withColumns(
        {
            "game_key": fault(60, 4, None, "game_key"),
            "event_team_key": team,
            "event_player_key": fault(80, 7, None, "event_player_key"),
            "event_player2_key": fault(90, 8, None, "event_player2_key"),
        }
    )
    wins = tables.wins.withColumns(
        {
            "led_to_shot": fault(25, 8, ~F.col("led_to_shot"), "led_to_shot"),
            "win_type": fault(20, 9, F.lit("Mystery"), "win_type"),
            "end_reason": fault(15, 1, None, "end_reason"),
            "x_coord": fault(45, 3, F.lit(10), "x_coord"),
            "seconds_to_shot": fault(10, 0, F.lit(99), "seconds_to_shot"),
        }
    )
    return replace(
        tables,
        clean=clean.unionByName(copies),
        events=events,
        wins=wins.unionByName(tables.wins.filter(at % 35 == 2)),
        players=tables.players.unionByName(tables.players.filter(F.col("player_key") % 3 == 0)),
        teams=tables.teams.unionByName(tables.teams.filter(F.col("team_key") == 2)),
    )


def _restarted(job: Callable[[DataFrame], DataFrame]) -> Query:
    """The events with ids that start anew for each user, far apart, and clocks that run backwards now and then."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = spark.read.parquet(f"{sf_dir}/events.parquet")
        per_user = Window.partitionBy("user_id").orderBy("event_id")
        late = F.col("ts") - F.make_dt_interval(hours=(F.col("event_id") * 13 % 29).cast("int"))
        return job(
            events.withColumn("event_number", F.row_number().over(per_user) * 1_000_003)
            .withColumn("ts", late)
            .withColumn("event_id", F.col("event_number").cast("long"))
            .drop("event_number")
        )

    return run


def queries() -> dict[str, Query]:
    by_type = marts.shot_rate_by_win_type
    return {
        "raw_events": raw_log,
        "ingest_csv": _through_csv,
        "ingest_csv_quoted": _quoted,
        "catalog_rows": _catalog_rows,
        "catalog_reopened": _catalog_reopened,
        "catalog_after_failed_build": _catalog_after_failure,
        "profile_file_rows": _file_profile("rows"),
        "profile_file_events": _file_profile("events"),
        "profile_file_extent": _file_profile("extent"),
        "profile_file_clocks": _file_profile("clocks"),
        "league_filter": _on_raw(_leagues),
        "clean_events": _on_raw(clean.clean_events),
        "clean_dedup_removed": _on_layers(_removed),
        "clock_parse": _counts("clock", "clock_seconds", "period_elapsed"),
        "zone_counts": _counts("zone"),
        "strength_counts": _counts("strength_state"),
        "skater_state_counts": _counts("skater_state"),
        "shot_flag_counts": _counts("event", "is_shot"),
        "game_ids_ranges": _on_raw(lambda raw: clean.game_ids(raw, limits=SMALL)),
        "dim_game": _on_layers(lambda t: dims.dim_game(t.clean)),
        "dim_team": _on_layers(lambda t: dims.dim_team(t.clean)),
        "dim_player": _on_layers(lambda t: dims.dim_player(t.clean)),
        "dim_player_ranges": _on_layers(lambda t: dims.dim_player(t.clean, limits=SMALL)),
        "fact_events": _on_layers(lambda t: t.events),
        "fact_events_player2": _on_layers(_second_players),
        "events_lagged": _on_layers(lambda t: wins.events_lagged(t.events_by_game)),
        "events_lagged_split": _on_layers(lambda t: wins.events_lagged(t.events, SMALL)),
        "wins_typed": _on_layers(lambda t: wins.wins_typed(t.events_by_game)),
        "window_first_event": _on_layers(_first_event),
        "window_first_end": _on_layers(_first_end),
        "window_first_shot": _on_layers(_first_shot),
        "win_outcome": _on_layers(_outcome),
        "fact_puck_wins": _on_layers(lambda t: wins.fact_puck_wins(t.events_by_game)),
        "fact_puck_wins_cut_games": _cut_games,
        "fact_puck_wins_split": _on_layers(lambda t: wins.fact_puck_wins(t.events, limits=SMALL)),
        "fact_puck_wins_late_clock": _on_layers(lambda t: wins.fact_puck_wins(_late(t))),
        "fact_puck_wins_late_clock_split": _on_layers(lambda t: wins.fact_puck_wins(_late(t), limits=SMALL)),
        "win_counts": _on_layers(lambda t: marts.win_counts(t.wins)),
        "shot_rate_grid": _on_wins(marts.shot_rate_grid),
        "shot_rate_grid_team": _on_wins(marts.shot_rate_grid, team="North"),
        "shot_rate_grid_player": _on_wins(marts.shot_rate_grid, player="Player 3"),
        "shot_rate_grid_strength": _on_wins(marts.shot_rate_grid, strength="PP"),
        "shot_rate_grid_win_type": _on_wins(marts.shot_rate_grid, win_type="Rebound"),
        "teams": _on_layers(lambda t: marts.team_list(t.win_tables)),
        "players": _on_layers(lambda t: marts.player_list(t.win_tables)),
        "players_team": _on_layers(lambda t: marts.player_list(t.win_tables, "North")),
        "win_type_list": _on_layers(lambda t: marts.win_type_list(t.win_tables)),
        "player_table": _on_wins(marts.player_table),
        "player_table_team": _on_wins(marts.player_table, team="North"),
        "player_table_strength": _on_wins(marts.player_table, strength="PP"),
        "player_table_win_type": _on_wins(marts.player_table, win_type="Forced Turnover"),
        "player_table_player": _on_wins(marts.player_table, player="Player 3"),
        "shot_rate_by_win_type": _on_layers(lambda t: by_type(t.win_tables)),
        "shot_rate_by_win_type_team": _on_layers(lambda t: by_type(t.win_tables, team="North")),
        "shot_rate_by_win_type_player": _on_layers(lambda t: by_type(t.win_tables, player="Player 3")),
        "shot_rate_by_win_type_strength": _on_layers(lambda t: by_type(t.win_tables, strength="EV")),
        "summary": _on_wins(marts.summary),
        "summary_team": _on_wins(marts.summary, team="North"),
        "summary_win_type": _on_wins(marts.summary, win_type="Rebound"),
        "summary_team_strength_type": _on_wins(marts.summary, team="East", strength="EV", win_type="Support"),
        "summary_empty": _on_wins(marts.summary, team="North", player="Nobody"),
        "end_reason": _on_wins(marts.end_reasons),
        "end_reason_team": _on_wins(marts.end_reasons, team="North"),
        "end_reason_shares": _on_wins(marts.end_reason_shares),
        "headline_rate": _on_layers(lambda t: marts.headline(t.win_tables)),
        "top_low_volume_player": _on_layers(lambda t: marts.lowest_volume_player(t.win_tables)),
        "dq_report_tables": _on_layers(checks.table_checks),
        "dq_report_tables_broken": _on_layers(lambda t: checks.table_checks(_broken(t))),
        "known_totals": _on_layers(
            lambda t: checks.known_total_checks(
                t, check_sql.KNOWN_ROWS, check_sql.KNOWN_RATE, check_sql.KNOWN_TOTALS
            )
        ),
        "dq_report_marts": _on_layers(_report_checks),
        "dq_report_marts_broken": _on_layers(_broken_reports),
        "profile_shape": _on_raw(P.shape),
        "profile_nulls": _on_raw(P.nulls),
        "profile_duplicates": _on_raw(lambda raw: extra_copies(raw, "event_id")),
        "profile_describe": _on_raw(lambda raw: _rounded(P.describe(raw, _numbers(raw)))),
        "profile_describe_ranges": _on_raw(lambda raw: _rounded(P.describe(raw, _numbers(raw), bins=3))),
        "profile_value_counts": _on_raw(lambda raw: P.value_counts(raw, "Event")),
        "profile_extent": _on_raw(lambda raw: P.extent(raw, COORDINATES)),
        "profile_distinct": _on_raw(lambda raw: P.distinct_values(raw, "Player 2")),
        "profile_head": _on_raw(lambda raw: P.head(raw, "event_id", 5)),
        "native_previous_event": _on_users(activity.previous_event),
        "native_click_to_purchase": _on_users(activity.click_outcomes),
        "native_click_restarted": _restarted(activity.click_outcomes),
        "native_click_restarted_split": _restarted(
            lambda e: activity.click_outcomes(e, limits=Limits(group_rows=60, chunk_rows=16, one_task_rows=500))
        ),
        "native_click_to_purchase_split": _on_users(
            lambda e: activity.click_outcomes(e, limits=Limits(group_rows=60, chunk_rows=512))
        ),
        **_llm(),
    }


def _numbers(raw: DataFrame) -> list[str]:
    """The numeric columns of the file; the row id is not one of them."""
    return [c for c in P.numeric_columns(raw) if c != "event_id"]


def _rounded(described: DataFrame) -> DataFrame:
    """Engines add in different orders, so the deviation agrees to 6 places, not to the last bit."""
    return described.withColumn("std", F.round("std", 6))


def oracle_sql() -> dict[str, str]:
    return check_sql.oracle_sql() | _llm_sql()
