"""Data checks. Each gives rows of (check, checked, violations); 0 violations is a pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressure.operators.dedup import repeated
from pressure.sources.scratch import keep

# Keys of one range: as many as a digest stands for.
RANGE_KEYS = 1 << 20


def _result(check: str, checked: Column, violations: Column) -> list[Column]:
    return [
        F.lit(check).alias("check"),
        F.coalesce(checked, F.lit(0)).cast("long").alias("checked"),
        F.coalesce(violations, F.lit(0)).cast("long").alias("violations"),
    ]


def rows_where(df: DataFrame, broken: dict[str, Column]) -> DataFrame:
    """Counts the rows that break each rule, all rules in one scan."""
    names = list(broken)
    counted = df.agg(
        F.count("*").alias("_n"), *[F.count_if(broken[name]).alias(f"_{i}") for i, name in enumerate(names)]
    )
    results = [F.struct(*_result(name, F.col("_n"), F.col(f"_{i}"))) for i, name in enumerate(names)]
    return counted.select(F.inline(F.array(*results)))


def expected_rows(check: str, df: DataFrame, expected: int) -> DataFrame:
    n = F.count("*")
    return df.agg(*_result(check, n, F.abs(n - F.lit(expected))))


def same_row_count(check: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """How far two tables are apart in rows, for instance a fact and its source."""
    sides = left.select(F.lit(1).alias("d")).unionAll(right.select(F.lit(-1).alias("d")))
    return sides.agg(*_result(check, F.count_if(F.col("d") == 1), F.abs(F.sum("d"))))


Counts = dict[str, tuple[Column, Column]]


def tally(parts: Sequence[tuple[DataFrame, Counts]]) -> DataFrame:
    """Checks whose counts come from several tables, each table read once.

    A part gives, by check, aggregates of its table: rows checked, and a signed number. The violations of a
    check are the absolute sum of its signed numbers: how far tables are apart, or rows that break a rule.
    """
    counted = [
        df.agg(*[F.struct(checked.alias("c"), signed.alias("d")).alias(f"_{i}") for i, (checked, signed) in enumerate(counts.values())]).select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(name).alias("check"), F.col(f"_{i}.c").cast("long").alias("c"), F.col(f"_{i}.d").cast("long").alias("d"))
                        for i, name in enumerate(counts)
                    ]
                )
            )
        )
        for df, counts in parts
    ]
    return reduce(DataFrame.unionAll, counted).groupBy("check").agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("checked"), F.abs(F.coalesce(F.sum("d"), F.lit(0))).alias("violations")
    )


def unique_key(check: str, df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Groups of rows that share a key."""
    groups = df.groupBy(*key).agg(F.count("*").alias("_n"))
    return groups.agg(*_result(check, F.sum("_n"), F.count_if(F.col("_n") > 1)))


def unique_rows(check: str, df: DataFrame, row_id: str) -> DataFrame:
    """Groups of rows that agree on everything but the id; only fingerprints of rows are shuffled."""
    n, none = F.count("*"), F.lit(0)
    return tally([(df, {check: (n, none)}), (repeated(df, row_id), {check: (none, F.count_if(F.col("_n") > 1))})])


def distinct_ids(check: str, df: DataFrame, column: str) -> DataFrame:
    n = F.count("*")
    return df.agg(*_result(check, n, n - F.count_distinct(column)))


def outside(column: str, values: Sequence[str]) -> Column:
    """Whether a value is not on the list; an unknown one is not."""
    return ~F.coalesce(F.col(column).isin(*values), F.lit(False))


def accepted_values(check: str, df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Distinct values outside the list."""
    groups = df.groupBy(column).agg(F.count("*").alias("_n"))
    return groups.agg(*_result(check, F.sum("_n"), F.count_if(outside(column, values))))


def _digests(side: DataFrame, sign: int) -> DataFrame:
    """Per range of keys: rows, and sums of hash halves, which are equal for equal rows in any order; negated for sign -1."""
    hashes = [F.xxhash64(F.lit(seed), "_key", "_known") for seed in range(2)]
    halves = [half for h in hashes for half in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    sums = [(F.try_sum(half) * sign).alias(f"_d{i}") for i, half in enumerate(halves)]
    return side.groupBy("_range").agg(F.count("*").alias("_rows"), (F.count("*") * sign).alias("_d"), *sums)


def null_parity(check: str, left: DataFrame, a: str, right: DataFrame, b: str, key: str) -> DataFrame:
    """Rows joined one to one where one side is unknown and the other is not.

    `key` is an integer, unique in `right`. Both tables are digested by range of keys, whatever their order. Ranges of equal
    digests hold equal rows and are counted without a join; only the rows of the other ranges meet.
    """

    def side(df: DataFrame, column: str) -> DataFrame:
        known = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("_key"), F.col(column).isNotNull().alias("_known"))
        return known.withColumn("_range", F.floor(F.col("_key") / RANGE_KEYS))

    one, two = side(left, a), side(right, b)
    parts = [f"_d{i}" for i in ("", 0, 1, 2, 3)]
    both = _digests(one, 1).unionAll(_digests(two, -1)).groupBy("_range")
    same = reduce(lambda x, y: x & y, [F.coalesce(F.try_sum(part) == 0, F.lit(False)) for part in parts])  # unknown: too many rows to add up
    # One row per range that the tables share or not.
    ranges = keep(both.agg(F.max("_rows").alias("_rows"), same.alias("_same")), "ranges")
    differ = ranges.where(~F.col("_same")).select("_range")
    n, none = F.count("*"), F.lit(0)
    equal = (ranges.where("_same"), {check: (F.sum("_rows"), none)})
    if differ.isEmpty():
        return tally([equal])
    pairs = one.join(differ, "_range", "left_semi").join(
        two.join(differ, "_range", "left_semi").select("_key", F.col("_known").alias("_other")), "_key"
    )
    return tally([equal, (pairs, {check: (n, F.count_if(F.col("_known") != F.col("_other")))})])


def report(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
