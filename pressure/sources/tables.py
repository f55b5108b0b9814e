"""Databases and tables of the session catalog."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYERS = ("staging", "clean", "warehouse")


def create_layers(spark: SparkSession, names: Sequence[str] = LAYERS) -> list[str]:
    """Creates the databases that are missing; returns those present, sorted."""
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    return layers_present(spark, names)


def layers_present(spark: SparkSession, names: Sequence[str] = LAYERS) -> list[str]:
    return sorted(db.name for db in spark.catalog.listDatabases() if db.name in names)


def _folder(name: str, root: str) -> str:
    return f"{root.rstrip('/')}/{name.replace('.', '/')}"


def replace_table(df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Creates or replaces a table and returns it; under `root` if one is given."""
    writer = df.write.mode("overwrite").format("parquet")
    if root is not None:
        writer = writer.option("path", _folder(name, root))
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def forget(spark: SparkSession, names: Iterable[str]) -> None:
    """Drops names of tables and views from the catalog; files of tables written under a root stay."""
    for name in names:
        kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} {name}")


def row_counts(spark: SparkSession, names: Iterable[str]) -> dict[str, int]:
    """Rows per table, read from the Parquet footers."""
    return {name: spark.table(name).count() for name in names}


def read_tables(spark: SparkSession, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: spark.table(name) for name in names}


def missing(spark: SparkSession, names: Iterable[str]) -> list[str]:
    return [name for name in names if not spark.catalog.tableExists(name)]


def dense_ids(df: DataFrame, column: str) -> bool:
    """Whether the column is exactly 1, 2, 3 ... up to the row count."""
    n, low, high, total = df.agg(
        F.count(column), F.min(column), F.max(column), F.sum(F.col(column).cast("decimal(38,0)"))
    ).first()
    return n == 0 or (low == 1 and high == n and int(total) == n * (n + 1) // 2)
