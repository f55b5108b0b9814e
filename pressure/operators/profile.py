"""Column profiles of a table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressure.sources.scratch import keep

_QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
_ENDS = {"min": F.min, "max": F.max}


def _per_column(counted: DataFrame, rows: Sequence[Column]) -> DataFrame:
    return counted.select(F.inline(F.array(*rows)))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("long"))


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    return df.dtypes


def numeric_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema.fields if isinstance(field.dataType, T.NumericType)]


def nulls(df: DataFrame) -> DataFrame:
    """Type, known values and unknown values of every column, in one scan."""
    counted = df.agg(
        F.count("*").alias("_n"), *[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns)]
    )
    return _per_column(
        counted,
        [
            F.struct(
                F.lit(name).alias("column"),
                F.lit(kind).alias("type"),
                F.col(f"_{i}").alias("non_null"),
                (F.col("_n") - F.col(f"_{i}")).alias("nulls"),
            )
            for i, (name, kind) in enumerate(df.dtypes)
        ],
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Known values by frequency, the most frequent first."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Every value once, the unknown one too."""
    return df.select(F.col(column).alias("value")).distinct()


def extent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counted = df.agg(
        *[agg(F.col(c).cast("double")).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, agg in _ENDS.items()]
    )
    return _per_column(
        counted,
        [
            F.struct(F.lit(c).alias("column"), F.col(f"min_{i}").alias("min"), F.col(f"max_{i}").alias("max"))
            for i, c in enumerate(columns)
        ],
    )



def head(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(order).limit(n)


def _quarter_ranks(n: int, q: float) -> tuple[int, int, float]:
    """The ranks from 0 that a quartile of n values lies between, and how far it is from the lower one."""
    position = (n - 1) * q
    low = math.floor(position)
    return low, math.ceil(position), position - low


def _magnitude_bin(value: Column) -> Column:
    """Bins in the order of the values: by sign, then 32 a power of two. NaN is the largest."""
    size = F.rint(F.log2(F.abs(value)) * 32) + 2 ** 16  # above 0 for every double
    return F.when(value == 0, F.lit(0.0)).when(value < 0, -size).otherwise(size)


class _Selection:
    """The values at some ranks of every column, found by histograms that narrow pass by pass.

    A pass counts the bins of the ranges that still hold a rank; no value is shuffled. A bin with one value is settled. Bins follow the
    order of the values whatever is rounded, so ranks are exact.
    """

    def __init__(self, df: DataFrame, columns: Sequence[str], bins: int):
        self.df, self.columns, self.bins = df, columns, bins
        self.values: dict[tuple[int, int], float] = {}

    def narrowed(self, ranges: list[tuple[int, float, float]]) -> list[list[tuple[float, float, int]]]:
        """(least, largest, rows) of each bin of the given ranges (column, from, to), in order."""
        rows = []
        for i, column in enumerate(self.columns):
            value = F.col(f"`{column}`").cast("double")
            # Ranges of a column do not overlap; each is a branch, at most six a column.
            for at, (of, low, high) in enumerate(ranges):
                if of == i:
                    share = (value - F.lit(low)) / (F.lit(high) - F.lit(low))
                    bin = F.when(value.between(low, high), F.rint(share * self.bins))
                    rows.append(F.struct(F.lit(at).alias("range"), bin.alias("bin"), value.alias("value")))
        return self.counted(rows, len(ranges))

    def counted(self, rows: list[Column], ranges: int) -> list[list[tuple[float, float, int]]]:
        out: list[list] = [[] for _ in range(ranges)]
        if not rows:
            return out
        spread = self.df.select(F.inline(F.array(*rows))).where(F.col("bin").isNotNull())
        counts = spread.groupBy("range", "bin").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("n"))
        # Bounded whatever the table holds: `bins` + 1 rows in each of six ranges a column; in the first pass one row for each
        # sign and 32nd of a power of two, 140,000 a column.
        for r in counts.orderBy("range", "bin").collect():
            out[r["range"]].append((r["low"], r["high"], r["n"]))
        return out

    def run(self, ranks: dict[int, Sequence[int]]) -> dict[tuple[int, int], float]:
        """{(column, rank): value}."""
        whole = []
        for i, column in enumerate(self.columns):
            value = F.col(f"`{column}`").cast("double")
            whole.append(F.struct(F.lit(i).alias("range"), _magnitude_bin(value).alias("bin"), value.alias("value")))
        # By range: its column, and (rank in the column, rank in the range) of the values that lie in it.
        asked = [(i, [(rank, rank) for rank in ranks[i]]) for i in range(len(self.columns))]
        found = self.counted(whole, len(self.columns))
        while asked:
            ranges, next_asked = [], []
            for (i, wanted), bins in zip(asked, found, strict=True):
                before = 0
                for low, high, n in bins:
                    inside = [(full, rank) for full, rank in wanted if before <= rank < before + n]
                    if inside and (low == high or math.isnan(low)):
                        self.values.update({(i, full): low for full, _ in inside})
                    elif inside:
                        ranges.append((i, low, high))
                        next_asked.append((i, [(full, rank - before) for full, rank in inside]))
                    before += n
            asked, found = next_asked, self.narrowed(ranges)
        return self.values


def describe(df: DataFrame, columns: Sequence[str], bins: int = 4096) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of numeric columns.

    Quartiles come from histograms: the first pass bins values by magnitude, each later one cuts the few bins that hold
    a quartile's ranks into `bins` parts. Whole numbers take two or three passes, any doubles six at 4,096 bins.
    """
    parts = {"count": F.count, "mean": F.avg, "std": F.stddev, "min": F.min, "max": F.max}
    names = [F.col(f"`{c}`").cast("double") for c in columns]
    if not names:
        return df.sparkSession.createDataFrame([], "column string, count long, " + ", ".join(f"{c} double" for c in ("mean", "std", "min", *_QUARTILES, "max")))
    counted = keep(df.agg(*[agg(c).alias(f"{part}_{i}") for i, c in enumerate(names) for part, agg in parts.items()]), "moments")
    (known,) = counted.collect()
    sizes = {i: known[f"count_{i}"] for i in range(len(columns))}
    places = {i: {name: _quarter_ranks(n, q) for name, q in _QUARTILES.items()} for i, n in sizes.items() if n}
    ranks = {i: sorted({r for low, high, _ in places.get(i, {}).values() for r in (low, high)}) for i in sizes}
    at = _Selection(df, columns, bins).run(ranks)

    def quartile(i: int, name: str) -> Column:
        if i not in places:
            return F.lit(None).cast("double")
        low, high, part = places[i][name]
        return F.lit(at[i, low] + (at[i, high] - at[i, low]) * part if part else at[i, low]).cast("double")

    return _per_column(
        counted,
        [
            F.struct(
                F.lit(c).alias("column"),
                *[F.col(f"{part}_{i}").alias(part) for part in ("count", "mean", "std", "min")],
                *[quartile(i, name).alias(name) for name in _QUARTILES],
                F.col(f"max_{i}").alias("max"),
            )
            for i, c in enumerate(columns)
        ],
    )
