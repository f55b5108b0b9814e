"""What came just before an event, and what came first after it.

Rows form groups (a game, a period of a game, a user) and have an integer order value that is
unique in the group; values may repeat in other groups. A group small enough for one task is one
window partition. A larger group is cut into runs of neighbouring rows, each run is scanned on its
own, and one row per run carries the result of the earlier runs into the later ones. No step pairs
the rows of a group with each other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressure.config import LIMITS, Limits
from pressure.operators.ordering import row_numbers
from pressure.sources.scratch import keep, keep_counted

RUN = "_run"


@dataclass(frozen=True)
class Laid:
    """A table stored by group: ordinary groups whole, large ones cut into runs numbered by the column RUN.

    Both are bucketed by what the scans partition by, so scanning them moves no row.
    """

    ordinary: DataFrame
    runs: DataFrame

    def select(self, *columns: str) -> Laid:
        return Laid(self.ordinary.select(*columns), self.runs.select(*columns, RUN))

    def whole(self) -> DataFrame:
        return self.ordinary.unionByName(self.runs.drop(RUN))


Aggregates = dict[str, tuple[Callable[[Column], Column], Column]]


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def large_groups(df: DataFrame, by: Sequence[str], limits: Limits = LIMITS) -> DataFrame:
    """The groups that are more than a task should hold: at most total rows / group_rows of them."""
    sizes = df.groupBy(*by).agg(F.count("*").alias("_rows"))
    return sizes.filter(F.col("_rows") > limits.group_rows).select(*by)


def split_groups(
    df: DataFrame, large: DataFrame, by: Sequence[str], order: str, limits: Limits = LIMITS
) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary groups, and those of the large ones with the number of their run."""
    ordinary = df.join(large, _same(df, large, by), "left_anti")
    rest = df.join(large, _same(df, large, by), "left_semi")
    numbered = row_numbers(rest, [*by, order], "_row", limits.one_task_rows)
    return ordinary, numbered.withColumn(RUN, F.expr(f"_row DIV {limits.chunk_rows}")).drop("_row")


def split_by_size(
    df: DataFrame | Laid,
    by: Sequence[str],
    order: str,
    job: Callable[[DataFrame, str | None], DataFrame],
    limits: Limits = LIMITS,
) -> DataFrame:
    """Runs `job(rows, None)` on ordinary groups and `job(rows, run)` on the large ones.

    `run` names a column that numbers the runs a large group is cut into, `chunk_rows` rows each
    however sparse the order values are. A table stored by group is taken as it was cut.
    """
    if isinstance(df, Laid):
        return job(df.ordinary, None).unionByName(job(df.runs, RUN).drop(RUN))
    large = large_groups(df, by, limits)
    if large.isEmpty():
        return job(df, None)
    # Spark broadcasts these if their size allows.
    ordinary, runs = split_groups(df, keep(large, "large-groups"), by, order, limits)
    return job(ordinary, None).unionByName(job(runs, RUN).drop(RUN))


def scan(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    aggregates: Aggregates,
    run: str | None,
    after: bool = False,
    own_row: bool = False,
) -> DataFrame:
    """Adds each `name: (F.min or F.max, value)` over the rows before (or `after`) this one.

    With `run`, rows are scanned run by run, and what the earlier runs hold is looked up from
    a table with one row per run.
    """
    last = Window.currentRow if own_row else -1

    def window(keys: Sequence[str], sort: str, upto: int) -> Window:
        direction = F.desc(sort) if after else F.asc(sort)
        return Window.partitionBy(*keys).orderBy(direction).rowsBetween(Window.unboundedPreceding, upto)

    keys = [*by, run] if run else list(by)
    inside = window(keys, order, last)
    scanned = df.withColumns({name: agg(value).over(inside) for name, (agg, value) in aggregates.items()})
    if run is None:
        return scanned

    # Written, so that scans built on this one do not work the totals out again.
    totals = keep(
        df.groupBy(*keys).agg(*[agg(value).alias(name) for name, (agg, value) in aggregates.items()]), "runs"
    )
    earlier = window(by, run, -1)
    carried = totals.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        *[agg(F.col(name)).over(earlier).alias(f"_carried_{name}") for name, (agg, _) in aggregates.items()],
    )
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    pick = {F.min: F.least, F.max: F.greatest}
    return (
        scanned.join(carried, match, "left")
        .withColumns(
            {name: pick[agg](F.col(name), F.col(f"_carried_{name}")) for name, (agg, _) in aggregates.items()}
        )
        .drop(*carried.columns)
    )


def previous_row(
    df: DataFrame, by: Sequence[str], order: str, columns: Sequence[str], run: str | None, name: str = "previous"
) -> DataFrame:
    """Adds `name`, a struct of `columns` of the row just before this one in its group."""
    value = F.struct(F.col(order).alias("_at"), *columns)
    return scan(df, by, order, {name: (F.max, value)}, run)


def first_outcome(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    time: str,
    side: Column,
    anchor: Column,
    success: Column,
    stop: Column,
    horizon: int,
    payload: Sequence[str],
    run: str | None,
) -> DataFrame:
    """For every anchor row: what came first among the later rows of its group?

    A later row (by `order`) is seen if its integer `time` is at most the anchor's plus
    `horizon`. `end` is the first seen row of another side, or the first stop of any side.
    `hit` is the first seen success of the anchor's side, given only if it precedes `end`.
    Both are structs of `order`, `time` and `payload`, null if there is none.

    The first closing row and the first success come from two window passes. They settle an
    anchor unless times run backwards later in the group, which the smallest later time shows;
    those anchors, and anchors without a side, go to an exact search.
    """
    rows = df.withColumns(
        {
            "_side": side,
            "_anchor": F.coalesce(anchor, F.lit(False)),
            "_success": F.coalesce(success, F.lit(False)) & side.isNotNull(),
            "_stop": F.coalesce(stop, F.lit(False)),
        }
    )
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*by, time]])
    rows = rows.withColumn("_seen", known & (F.col("_side").isNotNull() | F.col("_stop")))

    found = F.struct(F.col(order).alias(order), F.col(time).alias(time), "_side", "_success", "_stop", *payload)
    seen = F.col("_seen")
    rows = scan(
        rows,
        by,
        order,
        {"_next": (F.min, F.when(seen, found)), "_low": (F.min, F.when(seen, F.col(time)))},
        run,
        after=True,
    )
    # `_next` follows this row directly, so `_low` is the smallest time from it onwards.
    following = F.struct(f"_next.{order}", f"_next.{time}", "_low", *[f"_next.{c}" for c in payload])
    turns = F.col("_next._stop") | (F.col("_next._side") != F.col("_side"))
    rows = scan(
        rows,
        by,
        order,
        {
            "_close": (F.min, F.when(seen & turns, following)),
            "_hit": (F.min, F.when(seen & F.col("_next._success"), following)),
        },
        run,
        after=True,
        own_row=True,
    ).filter("_anchor")

    limit = F.col(time) + F.lit(horizon)
    close, hit = F.col("_close"), F.col("_hit")
    hit_first = hit.isNotNull() & (close.isNull() | (hit[order] < close[order]))
    unsettled = known & (
        F.col("_side").isNull()
        | (close.isNotNull() & (close[time] > limit) & (close["_low"] <= limit))
        | (hit_first & (hit[time] > limit) & (hit["_low"] <= limit))
    )

    def shown(value: Column, condition: Column) -> Column:
        fields = F.struct(*[value[c].alias(c) for c in [order, time, *payload]])
        return F.when(seen & F.col("_side").isNotNull() & condition, fields)

    anchors, unclear = keep_counted(
        rows.select(
            *df.columns,
            "_side",
            shown(close, close[time] <= limit).alias("end"),
            shown(hit, hit_first & (hit[time] <= limit)).alias("hit"),
            F.coalesce(unsettled, F.lit(False)).alias("_unsettled"),
        ),
        "anchors",
        F.col("_unsettled"),
    )
    settled = anchors.filter(~F.col("_unsettled")).drop("_side", "_unsettled")
    if unclear == 0:
        return settled
    rest = anchors.filter("_unsettled").drop("_unsettled")
    false = F.lit(False)
    events = df.withColumns(
        {"_side": side, "_success": F.coalesce(success, false), "_stop": F.coalesce(stop, false)}
    )
    return settled.unionByName(
        _search(rest, events, by, order, time, horizon, payload, run).select(*settled.columns)
    )


def _search(
    anchors: DataFrame,
    events: DataFrame,
    by: Sequence[str],
    order: str,
    time: str,
    horizon: int,
    payload: Sequence[str],
    run: str | None,
) -> DataFrame:
    """Exact `end` and `hit` when times run backwards, for few or many anchors.

    What the two window passes found inside the limit stands. If their candidate lay beyond it,
    the true answer comes later in the log at an earlier time, so only such late events are
    searched (and the stops, for anchors without a side, which the passes left out).

    "Time at most t" is split into blocks of 1, 2, 4 ... time units, one per set bit of t + 1.
    Each event joins the block that holds it at every size, each anchor asks the blocks that
    make up its limit, and inside a block only the order matters: the next event after the
    anchor, and the next of another side, are found by windows. Rows grow by the logarithm of
    the time span, not by pairs.
    """
    runs = [run] if run else []
    side, mine = F.col("_side"), F.col("_side").isNotNull()
    spans = (
        anchors.groupBy(*by)
        .agg(F.min(time).alias("_first"), F.max(time).alias("_last"), F.max(side.isNull()).alias("_blind"))
        .select(
            *by,
            "_blind",
            (F.col("_first") + F.lit(horizon)).cast("long").alias("_from"),
            (F.col("_last") + F.lit(horizon)).cast("long").alias("_to"),
        )
    )
    fields = [order, time, *payload]
    any_lane, stop_lane, hit_lane = (
        F.struct(F.lit(kind).alias("kind"), F.when(F.lit(kind == "hit"), side).alias("of"))
        for kind in ("any", "stop", "hit")
    )
    event_lanes = F.array(
        F.when(mine | F.col("_stop"), any_lane),
        F.when(F.col("_stop"), stop_lane),
        F.when(mine & F.col("_success"), hit_lane),
    )
    near = scan(events.join(spans, list(by)), by, order, {"_latest": (F.max, F.col(time))}, run)
    late = (F.col(time) < F.col("_latest")) | (F.col("_stop") & F.col("_blind"))
    event_rows = (
        near.filter(late & (F.col(time) <= F.col("_to")))
        .withColumn("_at", F.greatest(F.col(time).cast("long"), F.col("_from")) - F.col("_from"))
        .withColumn("_lane", F.explode(F.array_compact(event_lanes)))
        .withColumn(
            "_level",
            F.explode(
                F.expr("filter(sequence(0, length(bin(_to - _from + 1)) - 1), l -> shiftright(_at, l) % 2 = 0)")
            ),
        )
        .select(
            *by,
            *runs,
            "_lane",
            "_level",
            F.expr("shiftright(_at, _level)").alias("_block"),
            (F.col(order) * 2).alias("_place"),
            "_side",
            F.struct(*fields, "_side", "_stop").alias("_found"),
            F.lit(None).cast("long").alias("_asker"),
        )
    )
    ask_lanes = F.when(mine, F.array(any_lane, hit_lane)).otherwise(F.array(stop_lane))
    ask_rows = (
        anchors.join(spans, list(by))
        .withColumn("_upto", (F.col(time) + F.lit(horizon)).cast("long") - F.col("_from") + 1)
        .withColumn("_lane", F.explode(ask_lanes))
        .withColumn(
            "_level",
            F.explode(F.expr("filter(sequence(0, length(bin(_upto)) - 1), l -> shiftright(_upto, l) % 2 = 1)")),
        )
        .select(
            *by,
            *runs,
            "_lane",
            "_level",
            F.expr("shiftright(_upto, _level) - 1").alias("_block"),
            # An anchor sits just above its own event, so it sees later events only.
            (F.col(order) * 2 + 1).alias("_place"),
            "_side",
            F.lit(None).cast(event_rows.schema["_found"].dataType).alias("_found"),
            F.col(order).cast("long").alias("_asker"),
        )
    )
    block = [*by, "_lane", "_level", "_block"]
    rows = scan(
        event_rows.unionByName(ask_rows), block, "_place", {"_next": (F.min, F.col("_found"))}, run, after=True
    )
    closes = F.coalesce(F.col("_next._stop") | (F.col("_next._side") != side), F.lit(False))
    turn = F.when(F.col("_asker").isNull() & closes, F.col("_next"))
    rows = scan(rows, block, "_place", {"_turn": (F.min, turn)}, run, after=True, own_row=True)
    answer = F.when((F.col("_lane.kind") == "any") & ~closes, F.col("_turn")).otherwise(F.col("_next"))
    is_hit = F.col("_lane.kind") == "hit"
    answers = (
        rows.filter(F.col("_asker").isNotNull())
        .withColumn("_answer", answer)
        .withColumn("_answer", F.when(F.col("_answer").isNotNull(), F.struct(*[f"_answer.{c}" for c in fields])))
        .groupBy(*[F.col(c).alias(f"_of_{c}") for c in by], "_asker")
        .agg(
            F.min(F.when(~is_hit, F.col("_answer"))).alias("_end"),
            F.min(F.when(is_hit, F.col("_answer"))).alias("_hit"),
        )
    )
    # Order values may repeat in other groups, so an answer belongs to a group and an order value.
    own = reduce(lambda a, b: a & b, [anchors[c] == answers[f"_of_{c}"] for c in by], anchors[order] == answers["_asker"])
    both = (
        anchors.join(answers, own, "left")
        .withColumns({"end": F.coalesce("end", "_end"), "hit": F.coalesce("hit", "_hit")})
        .drop(*[f"_of_{c}" for c in by])
    )
    before_end = F.col("end").isNull() | (F.col(f"hit.{order}") < F.col(f"end.{order}"))
    return both.withColumn("hit", F.when(before_end, F.col("hit")))
