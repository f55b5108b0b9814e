"""Written intermediate tables in the folder that all executors share.

A written table cuts lineage and outlives any lost executor; reading it back also
gives Spark the true size to plan the next step with.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="pressure-"))
    return context.getCheckpointDir()


# Paths written inside the scopes that are open in this thread, innermost last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write the rows once and read them back."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    for scope_paths in _SCOPES.get()[-1:]:
        scope_paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep_counted(df: DataFrame, label: str, condition: Column | None = None) -> tuple[DataFrame, int]:
    """The same, with the number of rows (that meet a condition), counted while writing."""
    seen = Observation()
    count = F.count("*") if condition is None else F.count_if(condition)
    kept = keep(df.observe(seen, count.alias("n")), label)
    return kept, seen.get["n"]


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder name in the shared folder that nothing else uses."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables kept inside it at the end, also after a failure.

    Nothing may read them later. Scopes of other threads, and the ones around this one, keep theirs.
    """
    paths: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), paths))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        for path in paths:
            system, where = files_at(spark, path)
            system.delete(where, True)


def files_at(spark: SparkSession, path: str):
    """The file system that holds a path, and the path as it takes it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written here to the end."""
    system, where = files_at(spark, f"{path}/_SUCCESS")
    return system.exists(where)


def file_state(spark: SparkSession, path: str) -> tuple:
    """Path, size and last change of the files under a path."""
    system, where = files_at(spark, path)
    return (path, *[(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in system.listStatus(where)])
