"""Every registered query against its SQL on the small tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check_queries
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    yield connection
    connection.close()


# The queries of the log; those of subpackage llm have tests of their own.
OWN = sorted(set(entry.queries()) - set(entry._llm()))


def test_every_query_has_sql():
    assert set(OWN) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, con, name):
    assert check_queries.compare(spark, con, SF, name).startswith("ok")


def test_entry(spark):
    assert entry.entry(spark).count() == 6


def test_tables_are_built_once_per_input(spark):
    assert entry.layers(spark, SF) is entry.layers(spark, SF)


def test_one_file_in_order_is_written_without_a_sort(spark):
    log = spark.range(1000).select((F.col("id") * 37 % 1009).alias("event_id"), F.col("id").cast("string").alias("Event")).repartition(5)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        ordered = entry._in_order(log, "event_id")
    finally:
        spark.conf.set(name, old)
    assert len(ordered.inputFiles()) > 1
    one = ordered.coalesce(1)
    assert "Sort" not in one._jdf.queryExecution().toString()
    assert [r["event_id"] for r in one.collect()] == sorted(i * 37 % 1009 for i in range(1000))
    assert entry._in_order(log.limit(0), "event_id").collect() == []
