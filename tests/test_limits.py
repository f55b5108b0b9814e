"""The sizes a task may hold never change a result: the whole build under tiny limits."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fixture_log import raw_log
from pressure.config import Limits
from pressure.plans.build import build_scratch


@pytest.fixture(scope="module")
def tiny(spark):
    limits = Limits(group_rows=100, chunk_rows=48, one_task_rows=10, broadcast_rows=0)
    return build_scratch(raw_log(spark, "/root/testdata/sf0.01"), limits=limits)


@pytest.mark.parametrize("name", ["clean", "games", "teams", "players", "events", "wins", "counts"])
def test_same_table(layers, tiny, name):
    def digest(df):
        rows = F.xxhash64(*[F.struct(c) for c in df.columns]).cast("decimal(38,0)")
        return df.agg(F.count("*"), F.sum(rows)).first()

    assert digest(getattr(tiny, name)) == digest(getattr(layers, name))
