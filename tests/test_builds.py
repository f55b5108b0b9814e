from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pressure.config import Limits
from pressure.operators.sequence import Laid
from pressure.plans import build as B
from pressure.plans import facts, wins
from pressure.sources import builds
from pressure.sources.scratch import files_at
from pressure.sources.tables import forget
from tests.rows import raw_row, raw_table

PLAIN = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
ALL = [B.STAGED, "clean.events", "warehouse.dim_game", "warehouse.dim_team", "warehouse.dim_player", B.GAMES, B.RUNS,
       "warehouse.fact_puck_wins", "warehouse.win_counts"]


def csv(spark, path, n):
    rows = [raw_row(i, "Puck Recovery" if i % 2 else "Shot", at=i % 1100, team="Red" if i % 3 else "Blue") for i in range(1, n + 1)]
    raw_table(spark, rows).drop("event_id").coalesce(1).write.options(**PLAIN).csv(str(path))
    return str(path)


def counts(layers):
    return [df.count() for df in (layers.raw, layers.clean, layers.games, layers.teams, layers.players, layers.events, layers.wins, layers.counts)]


class Lost(Exception):
    pass


def folders(spark, root, part):
    system, path = files_at(spark, f"{root}/{part}")
    return sorted(f.getPath().getName() for f in system.listStatus(path))


def test_a_build_lost_after_any_table_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "tables")
    old = counts(B.build_all(spark, csv(spark, tmp_path / "old", 60), root))
    assert old[:2] == [60, 60] and old[5] == 60
    new = csv(spark, tmp_path / "new", 25)
    write, discard = builds.write, builds.discard
    monkeypatch.setattr(builds, "discard", lambda *_: None)  # a driver that is gone tidies nothing up
    for last in ALL:

        def stop(build, df, table, layout=None, last=last):
            rows = write(build, df, table, layout)
            if table == last:
                raise Lost
            return rows

        monkeypatch.setattr(builds, "write", stop)
        with pytest.raises(Lost):
            B.build_all(spark, new, root)
        monkeypatch.setattr(builds, "write", write)
        found = B.build_if_absent(spark, "/nowhere", root)
        assert [found.clean.count(), found.wins.count()] == [old[1], old[6]]
    assert counts(B.open_layers(spark, root)) == old
    assert spark.table(B.FACTS).count() == spark.table("clean.events").count() == 60
    monkeypatch.setattr(builds, "discard", discard)
    assert len(folders(spark, root, "manifests")) == 1 and len(folders(spark, root, "builds")) == 1 + len(ALL)
    # Nor does one that is lost while its manifest is put in place.
    monkeypatch.setattr(builds, "commit", lambda *_: (_ for _ in ()).throw(Lost))
    with pytest.raises(Lost):
        B.build_all(spark, new, root)
    monkeypatch.undo()
    assert counts(B.open_layers(spark, root)) == old
    assert len(folders(spark, root, "builds")) == 1 + len(ALL)  # that one could still delete its own
    assert len(builds.prune(spark, root, grace_hours=0)) == len(ALL)
    assert counts(B.build_all(spark, new, root))[:2] == [25, 25]
    assert counts(B.open_layers(spark))[:2] == [25, 25]


def test_readers_keep_their_build_and_old_ones_go(spark, tmp_path):
    root = str(tmp_path / "tables")
    paths = [csv(spark, tmp_path / str(n), n) for n in (10, 20, 30)]
    first = B.build_all(spark, paths[0], root)
    before = counts(first)
    second = B.build_all(spark, paths[1], root)
    assert counts(first) == before and counts(second)[0] == 20  # both are whole
    B.build_all(spark, paths[2], root)
    assert len(folders(spark, root, "builds")) == builds.KEPT_BUILDS == len(builds.manifests(spark, root))
    assert counts(second)[0] == 20 and counts(B.open_layers(spark, root))[0] == 30
    assert builds.newest(spark, root).number == 3
    assert builds.newest(spark, root).tables["clean.events"].rows == 30


def test_catalog_names_that_were_left_behind_are_pointed_at_the_newest_build(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "tables")
    B.build_all(spark, csv(spark, tmp_path / "a", 10), root)
    monkeypatch.setattr(builds, "publish", lambda *_: (_ for _ in ()).throw(Lost))
    with pytest.raises(Lost):  # after the commit
        B.build_all(spark, csv(spark, tmp_path / "b", 20), root)
    monkeypatch.undo()
    assert spark.table("clean.events").count() == 10
    assert counts(B.build_if_absent(spark, "/nowhere"))[0] == 20
    assert {spark.table(t).count() for t in ("clean.events", B.STAGED, B.FACTS)} == {20}
    forget(spark, [B.FACTS, "clean.events"])
    assert counts(B.build_if_absent(spark, "/nowhere", root))[0] == 20
    assert spark.table(B.FACTS).count() == 20


def test_half_a_manifest_and_a_table_without_files_are_no_build(spark, tmp_path):
    root = str(tmp_path / "tables")
    path = csv(spark, tmp_path / "a", 10)
    B.build_all(spark, path, root)
    (tmp_path / "tables" / "manifests" / ".half.tmp").write_text('{"number": 9')
    build = builds.newest(spark, root)
    assert build.number == 1
    system, where = files_at(spark, f"{build.path('warehouse.dim_team')}/_SUCCESS")
    system.delete(where, False)
    assert counts(B.build_if_absent(spark, path, root))[0] == 10
    assert builds.newest(spark, root).number == 2


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "Exchange" in line]


def test_scans_by_game_move_no_fact(spark, layers, monkeypatch):
    plans = []
    kept = wins.first_outcome.__globals__["keep_counted"]

    def seen(df, label, condition=None):
        if label == "anchors":
            plans.append(exchanges(df))
        return kept(df, label, condition)

    monkeypatch.setitem(wins.first_outcome.__globals__, "keep_counted", seen)
    assert isinstance(layers.events_by_game, type(layers.events))
    assert exchanges(wins.events_lagged(layers.events_by_game)) == []
    wins.fact_puck_wins(layers.events_by_game)
    assert plans == [[]]


def test_games_over_the_limit_are_kept_apart_and_give_the_same(spark, layers):
    build = builds.start(builds.start(f"{spark.conf.get('spark.checkpoint.dir')}/apart").root)
    table = facts.fact_events(layers.clean, layers.games, layers.teams, layers.players)
    table = table.filter((F.col("game_key") % 3 > 0) | (F.col("event_id") % 2 > 0))
    clean = layers.clean.join(table.select("event_id"), "event_id", "left_semi")
    sizes = dict(table.groupBy("game_key").count().collect())
    limits = Limits(group_rows=200, chunk_rows=64, one_task_rows=100)
    stored = B.store_events(build, clean, layers.games, table, limits)
    assert isinstance(stored, Laid)
    large = {g for g, n in sizes.items() if n > limits.group_rows}
    assert 0 < len(large) < len(sizes)
    assert {r[0] for r in stored.runs.select("game_key").distinct().collect()} == large
    assert stored.runs.groupBy("game_key", "_run").count().agg(F.max("count")).first()[0] <= 64
    assert sorted(map(str, stored.whole().collect())) == sorted(map(str, table.collect()))
    # No row of an ordinary game moves; of the large ones none before what the runs carry is looked up.
    assert exchanges(wins.with_previous(stored.ordinary, None)) == []
    for job in (wins.events_lagged, wins.fact_puck_wins, wins.first_own_shot):
        assert sorted(map(str, job(stored, limits=limits).collect())) == sorted(map(str, job(table).collect()))


def test_low_limits_ask_for_no_more_buckets_than_a_shuffle_has(spark):
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert B._buckets(spark, 6_000_000, Limits(chunk_rows=64)) == max(shuffled, 60)
    assert B._buckets(spark, 36_000_000, Limits()) == max(shuffled, 36)
    assert B._buckets(spark, 25_000, Limits()) == min(shuffled, 3)
    assert B._buckets(spark, 0, Limits()) == 1
