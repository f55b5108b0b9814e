"""Logs with nothing to report still build."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pressure.plans import activity, checks, marts
from pressure.plans.build import build_scratch
from pressure.sources.scratch import keep_counted
from tests.rows import raw_row, raw_table


@pytest.mark.parametrize(
    "rows",
    [[], [raw_row(1, home="NCAA - Red")], [raw_row(1), raw_row(2, "Shot", at=3)]],
    ids=["no rows", "no kept game", "no win"],
)
def test_build(spark, rows):
    built = build_scratch(raw_table(spark, rows))
    assert built.wins.count() == 0
    assert marts.summary(built.win_tables).first()["wins"] == 0
    assert marts.headline(built.win_tables).first()["shot_rate"] is None
    assert all(r["violations"] == 0 for r in checks.table_checks(built).collect() if "opponent" not in r["check"])


def test_counting_a_table_known_to_be_empty(spark):
    kept, count = keep_counted(spark.range(5).filter(F.lit(False)), "none")
    assert (kept.count(), count) == (0, 0)
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").filter(F.lit(False))
    assert activity.click_outcomes(events).count() == 0
