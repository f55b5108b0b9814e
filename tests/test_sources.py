from __future__ import annotations

import pytest

from fixture_log import raw_log
from pressure.config import Limits
from pressure.plans import build as B
from pressure.plans.profiling import profile_file, profile_folder
from pressure.sources import tables as T
from pressure.sources.csv_log import ingest_events, read_csv
from pressure.sources.scratch import shared_dir
from pressure.sources.schemas import RAW_COLUMNS

PLAIN = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The raw log as three CSV files in id order."""
    path = str(tmp_path_factory.mktemp("csv") / "log")
    log = raw_log(spark, "/root/testdata/sf0.01").repartitionByRange(3, "event_id").sortWithinPartitions("event_id")
    log.drop("event_id").write.options(**PLAIN).csv(path)
    return path


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=0)], ids=["broadcast", "shuffle"])
def test_ids_follow_the_files_across_many_blocks(spark, folder, limits):
    expected = [
        tuple(r)
        for r in raw_log(spark, "/root/testdata/sf0.01").orderBy("event_id").select("Clock", "Player", "Event", "Detail 1").collect()
    ]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64KB")
    try:
        df = ingest_events(spark, folder, limits)
        assert df.columns == ["event_id", *RAW_COLUMNS]
        got = df.orderBy("event_id").select("event_id", "Clock", "Player", "Event", "Detail 1").collect()
        assert read_csv(spark, folder).rdd.getNumPartitions() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r[0] for r in got] == list(range(1, len(expected) + 1))
    assert [tuple(r)[1:] for r in got] == expected
    assert T.dense_ids(df, "event_id")


def test_clock_stays_text(spark, folder):
    types = dict(read_csv(spark, folder).dtypes)
    assert (types["Clock"], types["game_date"], types["X Coordinate"]) == ("string", "date", "double")


def line(values: dict[str, str], names: list[str]) -> str:
    return ",".join(values.get(name, "") for name in names) + "\n"


def test_columns_are_found_by_name_and_others_kept(spark, tmp_path):
    names = ["Extra", *reversed(RAW_COLUMNS)]
    values = {"Event": '"Puck ""Recovery"""', "Period": "2", "Extra": "x", "X Coordinate": "12.5", "Clock": " 07:10"}
    (tmp_path / "a.csv").write_text(",".join(names) + "\n" + line(values, names))
    row = read_csv(spark, str(tmp_path / "a.csv")).first()
    assert (row["Event"], row["Period"], row["Extra"]) == ('Puck "Recovery"', 2, "x")
    assert (row["X Coordinate"], row["Clock"], row["Player"]) == (12.5, " 07:10", None)


def test_line_breaks_inside_quotes(spark, tmp_path):
    names = list(RAW_COLUMNS)
    (tmp_path / "a.csv").write_text(",".join(names) + "\n" + line({"Detail 1": '"two\nlines"'}, names))
    assert read_csv(spark, str(tmp_path), multi_line=True).first()["Detail 1"] == "two\nlines"
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path)).collect()


def test_wrong_header_or_value_is_an_error(spark, tmp_path):
    names = list(RAW_COLUMNS)
    head = ",".join(names) + "\n"
    (tmp_path / "short.csv").write_text(",".join(names[1:]) + "\n")
    with pytest.raises(ValueError, match="game_date"):
        read_csv(spark, str(tmp_path / "short.csv"))
    (tmp_path / "value.csv").write_text(head + line({"Period": "first"}, names))
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path / "value.csv")).collect()
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text(head + line({"Period": "1"}, names))
    (folder / "b.csv").write_text(",".join(reversed(names)) + "\n" + line({"Period": "1"}, names))
    with pytest.raises(Exception):
        read_csv(spark, str(folder)).collect()


def test_build_writes_every_table_and_can_run_again(spark, folder, tmp_path):
    root = str(tmp_path / "tables")
    B.build_all(spark, folder, root)
    assert T.layers_present(spark) == ["clean", "staging", "warehouse"]
    names = [B.STAGED, *B.TABLES]
    counts = T.row_counts(spark, names)
    assert counts["staging.events"] == 10104 and counts["clean.events"] == counts["warehouse.fact_events"] == 8750
    assert counts["warehouse.dim_game"] == 35 and counts["warehouse.fact_puck_wins"] == 1188
    B.build_all(spark, folder, root)
    assert T.row_counts(spark, names) == counts
    assert T.missing(spark, names) == []
    again = B.build_if_absent(spark, "/nowhere.csv")
    assert again.wins.count() == 1188
    assert set(T.read_tables(spark, names)) == set(names)
    spark.sql("DROP TABLE warehouse.dim_team")
    assert T.missing(spark, names) == ["warehouse.dim_team"]
    # The files are still there, so opening by folder needs no build.
    assert B.build_if_absent(spark, "/nowhere.csv", root).teams.count() == 4
    assert T.missing(spark, names) == []


def test_command_line(spark, folder, tmp_path, capsys):
    from pressure.__main__ import main

    main([folder, "--root", str(tmp_path / "cli")])
    assert "|1188|    0.125|" in capsys.readouterr().out


def test_dense_ids(spark):
    assert T.dense_ids(spark.range(1, 6), "id") and T.dense_ids(spark.range(0), "id")
    assert not T.dense_ids(spark.range(0, 5), "id")
    assert not T.dense_ids(spark.range(1, 6).union(spark.range(3, 4)), "id")


def test_profile_reads_files_by_name(spark, folder):
    parts = profile_folder(spark, folder)
    rows = {r["file"]: r["rows"] for r in parts["rows"].collect()}
    assert len(rows) == 3 and sum(rows.values()) == 10104
    assert sum(r["n"] for r in parts["events"].collect()) == 10104
    assert parts["extent"].columns[1:] == ["X Coordinate min", "X Coordinate max", "Y Coordinate min", "Y Coordinate max"]
    clocks = parts["clocks"].collect()
    assert [r["event_id"] for r in clocks][:4] == [1, 2, 3, rows[clocks[0]["file"]] + 1] and len(clocks) == 9
    whole = profile_file(spark, folder)
    assert dict(whole.columns)["Clock"] == "string" and whole.describe.count() == 9
    assert tuple(whole.shape.first()) == (10104, 21)
    # Copies differ only in their id, and so do events that happen to be alike.
    assert whole.duplicates.first()["duplicates"] == 104


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_line_breaks_inside_quotes(spark, tmp_path):
    values = [{"Event": '"Dump\nIn/Out"', "Period": "1"}, {"Event": "Shot", "Period": "2"}, {"Event": '"a ""b""\n\nc"', "Period": "3"}]
    (tmp_path / "a.csv").write_text(",".join(RAW_COLUMNS) + "\n" + "".join(line(v, RAW_COLUMNS) for v in values))
    rows = ingest_events(spark, str(tmp_path), multi_line=True).orderBy("event_id").collect()
    assert [(r["event_id"], r["Event"]) for r in rows] == [(1, "Dump\nIn/Out"), (2, "Shot"), (3, 'a "b"\n\nc')]
    T.create_layers(spark)
    staged = B.load_sources(spark, {str(tmp_path): "staging.breaks"}, str(tmp_path / "tables"), multi_line=True)
    assert staged["staging.breaks"].count() == 3


def test_scopes_delete_what_was_kept_in_them_also_after_a_failure(spark):
    from pressure.sources.scratch import keep, scope

    def there(df):
        path = df.inputFiles()[0].rsplit("/", 1)[0]
        return lambda: spark.sparkContext._jvm.java.io.File(path.removeprefix("file://").removeprefix("file:")).exists()

    outer = there(keep(spark.range(3), "outer"))
    with scope(spark):
        first = there(keep(spark.range(3), "first"))
        with pytest.raises(ZeroDivisionError), scope(spark):
            second = there(keep(spark.range(3), "second"))
            assert second() and 1 / 0
        assert first() and not second()
    assert outer() and not first()


def test_files_of_one_name_in_two_folders_stay_apart(spark, tmp_path):
    for name, n in (("x", 2), ("y", 3)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.csv").write_text(",".join(RAW_COLUMNS) + "\n" + line({"Event": "Shot"}, RAW_COLUMNS) * n)
    rows = profile_folder(spark, str(tmp_path / "*"))["rows"].collect()
    assert sorted(r["rows"] for r in rows) == [2, 3]
