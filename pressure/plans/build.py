"""Runs every layer in order, as one build that is seen whole or not at all."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressure.config import LIMITS, RULES, Limits, Rules
from pressure.operators.ordering import part_count
from pressure.operators.sequence import RUN, Laid, large_groups, split_groups
from pressure.plans.clean import clean_events
from pressure.plans.dims import dim_game, dim_player, dim_team
from pressure.plans.facts import fact_events
from pressure.plans.marts import WinTables, win_counts
from pressure.plans.wins import fact_puck_wins
from pressure.sources import builds
from pressure.sources.builds import Build, Layout
from pressure.sources.csv_log import ingest_events
from pressure.sources.scratch import keep, new_folder, scope, written
from pressure.sources.tables import create_layers, replace_table

STAGED = "staging.events"
FACTS = "warehouse.fact_events"
# The facts are stored in two parts: games that a task can hold, and the larger ones cut into runs.
GAMES, RUNS = f"{FACTS}_games", f"{FACTS}_runs"
TABLES = (
    "clean.events",
    "warehouse.dim_game",
    "warehouse.dim_team",
    "warehouse.dim_player",
    FACTS,
    "warehouse.fact_puck_wins",
    "warehouse.win_counts",
)
VIEWS = {FACTS: (GAMES, RUNS)}
# A file of a small table holds this many rows at least.
_BUCKET_ROWS = 10_000


@dataclass(frozen=True)
class Layers:
    """The built tables, each read back from where it was written."""

    raw: DataFrame
    clean: DataFrame
    games: DataFrame
    teams: DataFrame
    players: DataFrame
    events: DataFrame
    wins: DataFrame
    counts: DataFrame
    # The facts as they are stored, by game; None if they are not.
    stored_events: DataFrame | Laid | None = None

    @property
    def win_tables(self) -> WinTables:
        return WinTables(self.counts, self.teams, self.players)

    @property
    def events_by_game(self) -> DataFrame | Laid:
        """The facts for jobs that scan game by game: without a shuffle if they are stored so."""
        return self.events if self.stored_events is None else self.stored_events


def _buckets(spark: SparkSession, rows: int, limits: Limits) -> int:
    """As many as a shuffle has, fewer for a small table, more where one would hold more than `chunk_rows` rows."""
    return part_count(spark, rows, min(_BUCKET_ROWS, limits.chunk_rows), limits.chunk_rows)


def store_events(build: Build, clean: DataFrame, games: DataFrame, facts: DataFrame, limits: Limits = LIMITS) -> DataFrame | Laid:
    """Writes the facts by game, so that jobs over games need no shuffle, and reads them back.

    Each bucket holds whole games in order. Games of more than `group_rows` rows are kept apart, in
    buckets of whole runs.
    """
    spark = clean.sparkSession
    sizes = large_groups(clean, ["game_id"], limits).join(games.select("game_id", "game_key"), "game_id")
    large = keep(sizes.select("game_key"), "large-games")
    ordinary, runs = split_groups(facts, large, ["game_key"], "event_id", limits) if not large.isEmpty() else (facts, None)
    n = _buckets(spark, clean.count(), limits)
    layout = Layout(("game_key",), ("game_key", "event_id"), n)
    whole = builds.write(build, ordinary.repartition(n, "game_key"), GAMES, layout)
    if runs is None:
        runs = facts.withColumn(RUN, F.lit(None).cast("long")).where(F.lit(False))
    cut = Layout(("game_key", RUN), ("game_key", "event_id"), n)
    builds.write(build, runs.repartition(n, "game_key", RUN), RUNS, cut)
    return _stored(spark, build, whole)


def _stored(spark: SparkSession, build: Build, whole: DataFrame) -> DataFrame | Laid:
    return Laid(whole, builds.read(spark, build, RUNS)) if build.tables[RUNS].rows else whole


def build_layers(raw: DataFrame, build: Build, rules: Rules = RULES, limits: Limits = LIMITS) -> Layers:
    """Builds every table from raw rows with an event_id."""
    spark = raw.sparkSession

    def save(df: DataFrame, name: str) -> DataFrame:
        return builds.write(build, df, name)

    clean = save(clean_events(raw, rules, limits).sortWithinPartitions("game_id", "event_id"), "clean.events")
    games = save(dim_game(clean, limits), "warehouse.dim_game")
    teams = save(dim_team(clean, limits), "warehouse.dim_team")
    players = save(dim_player(clean, rules, limits), "warehouse.dim_player")
    events = store_events(build, clean, games, fact_events(clean, games, teams, players, rules), limits)
    by_game = ("game_key", "event_id")
    wins = fact_puck_wins(events, rules, limits)
    # Ranges of games in order; a game with many wins may lie in several files.
    wins = save(wins.repartitionByRange(*by_game).sortWithinPartitions(*by_game), "warehouse.fact_puck_wins")
    save(win_counts(wins, rules), "warehouse.win_counts")
    return _layers(spark, build, raw)


def _layers(spark: SparkSession, build: Build, raw: DataFrame) -> Layers:
    stored = _stored(spark, build, builds.read(spark, build, GAMES))
    whole = stored.whole() if isinstance(stored, Laid) else stored
    tables = [whole if name == FACTS else builds.read(spark, build, name) for name in TABLES]
    return Layers(raw, *tables, stored_events=stored)


def build_scratch(raw: DataFrame, rules: Rules = RULES, limits: Limits = LIMITS) -> Layers:
    """The layers in the shared folder, without names."""
    return build_layers(raw, builds.start(new_folder(raw.sparkSession, "layers")), rules, limits)


def load_sources(
    spark: SparkSession,
    sources: dict[str, str],
    root: str | None = None,
    limits: Limits = LIMITS,
    multi_line: bool = False,
) -> dict[str, DataFrame]:
    """Stages each CSV path under its table name, with file-order ids."""
    return {
        table: ingest_events(spark, path, limits, multi_line, lambda rows, name=table: replace_table(rows, name, root))
        for path, table in sources.items()
    }


def default_root(spark: SparkSession) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/pressure"


def _known_root(spark: SparkSession) -> str | None:
    """The root of the build that the catalog names point at."""
    where = builds.location(spark, STAGED)
    return where.rsplit("/builds/", 1)[0] if where and "/builds/" in where else None


def build_all(
    spark: SparkSession,
    csv_path: str,
    root: str | None = None,
    rules: Rules = RULES,
    limits: Limits = LIMITS,
    multi_line: bool = False,
) -> Layers:
    """CSV -> tables under `root`, and catalog names for them.

    All tables are written aside and become the newest build at once. A build that fails, or whose driver is lost,
    changes nothing: readers go on with the build before it. Intermediate tables are deleted, also after a failure.
    """
    create_layers(spark)
    build = builds.start(root or default_root(spark))
    try:
        with scope(spark):
            raw = ingest_events(spark, csv_path, limits, multi_line, lambda rows: builds.write(build, rows, STAGED))
            build_layers(raw, build, rules, limits)
        done = builds.commit(spark, build)
    except BaseException:
        builds.discard(spark, build)
        raise
    builds.publish(spark, done, VIEWS)
    builds.prune(spark, done.root)
    return open_build(spark, done)


def open_build(spark: SparkSession, build: Build) -> Layers:
    """The tables of one build, all of it, whatever is built meanwhile."""
    return _layers(spark, build, builds.read(spark, build, STAGED))


def open_layers(spark: SparkSession, root: str | None = None) -> Layers:
    """The newest build under `root`, by default where the catalog names point."""
    build = _newest(spark, root)
    if build is None:
        raise FileNotFoundError(f"no build under {root or default_root(spark)}")
    return open_build(spark, build)


def _newest(spark: SparkSession, root: str | None) -> Build | None:
    build = builds.newest(spark, root or _known_root(spark) or default_root(spark))
    return build if build and all(written(spark, build.path(table)) for table in build.tables) else None


def build_if_absent(spark: SparkSession, csv_path: str, root: str | None = None) -> Layers:
    """Opens the newest build and names its tables in this catalog; builds all if there is none."""
    create_layers(spark)
    build = _newest(spark, root)
    if build is None:
        return build_all(spark, csv_path, root)
    builds.publish(spark, build, VIEWS)
    return open_build(spark, build)
