from __future__ import annotations

import csv
import io
import random

import pytest

from pressure.config import Limits
from pressure.sources import csv_log
from pressure.sources.csv_log import ingest_events
from pressure.sources.schemas import RAW_COLUMNS
from pressure.sources.scratch import keep


def log(n, seed, breaks=0.3, end="\n"):
    """Text of a CSV file with line breaks, quotes and commas inside quotes, and blank lines between records."""
    rng = random.Random(seed)
    out = io.StringIO()
    write = csv.writer(out, lineterminator=end)
    write.writerow(RAW_COLUMNS)
    for i in range(n):
        row = dict.fromkeys(RAW_COLUMNS, "") | {"Period": str(i), "Event": "Shot"}
        if rng.random() < breaks:
            row["Detail 1"] = rng.choice(["two\nlines", '"', 'a ""b""\n\n\n"c"', "\n", "x," * 30 + "\n" * rng.randint(1, 5), 'q"\n' * 40 + "end"])
        write.writerow([row[c] for c in RAW_COLUMNS])
        if rng.random() < 0.05:
            out.write(end)
    return out.getvalue()


def expected(*texts):
    rows = [r for t in texts for r in csv.DictReader(io.StringIO(t, newline=""))]
    return [(i, int(r["Period"]), r["Detail 1"] or None) for i, r in enumerate(rows, 1)]


def found(df):
    return [(r["event_id"], r["Period"], r["Detail 1"]) for r in df.orderBy("event_id").collect()]


@pytest.fixture
def small_blocks(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("seed", range(3))
def test_line_breaks_in_quotes_over_many_blocks(spark, tmp_path, small_blocks, seed):
    texts = [log(150, seed), log(40, seed + 10, breaks=0.9), log(3, seed + 20, breaks=0)]
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.csv").write_text(text, newline="")
    df = ingest_events(spark, str(tmp_path), multi_line=True)
    assert df.columns == ["event_id", *RAW_COLUMNS]
    assert found(df) == expected(*texts)


def test_a_value_longer_than_blocks_and_windows_line_ends(spark, tmp_path, small_blocks):
    head = ",".join(RAW_COLUMNS)
    rest = "," * (len(RAW_COLUMNS) - 2)
    long = "\r\n".join(f'line ""{i}"", and more' for i in range(400))
    text = f'{head}\r\n1,{rest}\r\n"{long}",{rest}\r\n3,{rest}\r\n'
    (tmp_path / "a.csv").write_text(text.replace("1," + rest, "2020-01-01," + rest).replace(f'"{long}",{rest}', f'2020-01-02,"{long}"{rest}').replace("3," + rest, "2020-01-03," + rest), newline="")
    rows = ingest_events(spark, str(tmp_path), multi_line=True).orderBy("event_id").collect()
    assert [r["event_id"] for r in rows] == [1, 2, 3]
    assert rows[1][2].replace("\r\n", "\n") == long.replace("\r\n", "\n").replace('""', '"')


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_text(log(300, 9), newline="")
    with csv_log.fixed_splits(spark):
        blocks = spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions()
    assert blocks > 10
    assert len(found(ingest_events(spark, str(tmp_path), multi_line=True))) == 300


def test_small_blocks_share_tasks(spark, tmp_path, small_blocks):
    text = log(300, 9)
    (tmp_path / "a.csv").write_text(text, newline="")
    (tmp_path / "b.csv").write_text(text, newline="")
    tasks = []

    def write(df):
        tasks.append(df.rdd.getNumPartitions())
        return keep(df, "shared-tasks")

    assert found(ingest_events(spark, str(tmp_path), multi_line=True, write=write)) == expected(text, text)
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The blocks, over 20, and the records put together from pieces.
    assert tasks[0] <= 2 * shuffled < 20


def test_open_quotes_and_other_headers_are_errors(spark, tmp_path):
    (tmp_path / "a.csv").write_text(log(5, 1) + '2020-01-01,"no end')
    with pytest.raises(ValueError, match="inside quotes"):
        ingest_events(spark, str(tmp_path), multi_line=True)
    (tmp_path / "a.csv").write_text(log(5, 1))
    (tmp_path / "b.csv").write_text(",".join(reversed(RAW_COLUMNS)) + "\n")
    with pytest.raises(ValueError, match="header"):
        ingest_events(spark, str(tmp_path), multi_line=True)


def test_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(RAW_COLUMNS) + "\n")
    for multi_line in (False, True):
        df = ingest_events(spark, str(tmp_path), multi_line=multi_line)
        assert df.columns == ["event_id", *RAW_COLUMNS] and df.collect() == []


@pytest.mark.parametrize("multi_line", [False, True])
def test_rows_are_written_once_and_cut_alike_by_more_executors(spark, tmp_path, small_blocks, multi_line):
    text = log(400, 4, breaks=0.3 if multi_line else 0)
    (tmp_path / "a.csv").write_text(text, newline="")
    written = []
    old = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)

    def write(df):
        # Executors join between the count and the read.
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "97")
        written.append(1)
        return keep(df, "once")

    try:
        df = ingest_events(spark, str(tmp_path), multi_line=multi_line, write=write)
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism") if old is None else spark.conf.set("spark.sql.leafNodeDefaultParallelism", old)
    assert written == [1] and found(df) == expected(text)


def test_a_file_that_changes_between_count_and_read_is_an_error(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(log(20, 5, breaks=0))

    def write(df):
        path.write_text(log(21, 5, breaks=0))
        return keep(df, "changed")

    with pytest.raises(Exception):
        ingest_events(spark, str(tmp_path), limits=Limits(), write=write)
