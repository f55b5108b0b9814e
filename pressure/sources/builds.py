"""Builds that become visible whole or not at all.

Every build writes its tables into a folder of its own, and a manifest last. Readers take the newest
manifest and open exactly the tables it names, so a build that is under way, or that was lost midway, is never
seen: the build before it still is. Manifests are written aside and renamed, so none is seen half written; two builds at
one time both get a manifest, and the later number, then the greater name, is the newest.

    root/builds/<build>/<layer>/<table>/      Parquet
    root/manifests/<number>-<build>.json      tables with their rows and layout

Catalog names are pointed at the newest build one by one; a reader that needs all tables of one
build opens them through the manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pressure.sources.scratch import files_at

# Database of the names under which bucketed tables are opened, one a build.
OPENED = "builds"
# Manifests of the newest builds that stay; the folders of older ones go.
KEPT_BUILDS = 2
# A folder without a manifest is left alone this long: its build may still be running.
GRACE_HOURS = 48


@dataclass(frozen=True)
class Layout:
    """Rows hashed by `buckets_by` into `buckets` files, each sorted by `sorted_by`."""

    buckets_by: tuple[str, ...]
    sorted_by: tuple[str, ...]
    buckets: int


@dataclass(frozen=True)
class Stored:
    """A written table: folder under the root, columns, rows, layout if it is bucketed."""

    folder: str
    columns: str
    rows: int
    layout: Layout | None = None


@dataclass(frozen=True)
class Build:
    root: str
    name: str
    number: int = 0
    tables: dict[str, Stored] = field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.root}/{self.tables[table].folder}"


def start(root: str) -> Build:
    return Build(root.rstrip("/"), uuid.uuid4().hex)


def write(build: Build, df: DataFrame, table: str, layout: Layout | None = None) -> DataFrame:
    """Writes a table of a build, counts it on the way, and reads it back."""
    folder = f"builds/{build.name}/{table.replace('.', '/')}"
    seen = Observation()
    writer = df.observe(seen, F.count("*").alias("n")).write
    if layout is None:
        writer.parquet(f"{build.root}/{folder}")
    else:
        _database(df.sparkSession)
        writer = writer.bucketBy(layout.buckets, *layout.buckets_by).sortBy(*layout.sorted_by)
        writer.format("parquet").option("path", f"{build.root}/{folder}").saveAsTable(_opened_name(build, table))
    columns = df.schema.json()
    build.tables[table] = Stored(folder, columns, seen.get["n"], layout)
    return read(df.sparkSession, build, table)


def commit(spark: SparkSession, build: Build) -> Build:
    """Makes the build the newest one."""
    last = newest(spark, build.root)
    done = Build(build.root, build.name, (last.number if last else 0) + 1, build.tables)
    system, folder = files_at(spark, f"{build.root}/manifests")
    system.mkdirs(folder)
    text = json.dumps({"number": done.number, "name": done.name, "tables": {t: asdict(s) for t, s in done.tables.items()}})
    _, aside = files_at(spark, f"{build.root}/manifests/.{done.name}.tmp")
    out = system.create(aside, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    _, final = files_at(spark, f"{build.root}/manifests/{done.number:010d}-{done.name}.json")
    if not system.rename(aside, final):
        raise RuntimeError(f"the manifest of build {done.name} could not be put in place")
    return done


def manifests(spark: SparkSession, root: str) -> list[str]:
    """File names of all manifests, oldest first."""
    system, folder = files_at(spark, f"{root.rstrip('/')}/manifests")
    if not system.exists(folder):
        return []
    names = [f.getPath().getName() for f in system.listStatus(folder)]
    return sorted(n for n in names if n.endswith(".json") and not n.startswith("."))


def _load(spark: SparkSession, root: str, manifest: str) -> Build:
    system, path = files_at(spark, f"{root}/manifests/{manifest}")
    stream = system.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    read_back = json.loads(text)
    tables = {}
    for table, stored in read_back["tables"].items():
        laid = stored.pop("layout")
        layout = Layout(tuple(laid["buckets_by"]), tuple(laid["sorted_by"]), laid["buckets"]) if laid else None
        tables[table] = Stored(**stored, layout=layout)
    return Build(root, read_back["name"], read_back["number"], tables)


def newest(spark: SparkSession, root: str) -> Build | None:
    """The newest build that was written to the end."""
    found = manifests(spark, root)
    return _load(spark, root.rstrip("/"), found[-1]) if found else None


def _database(spark: SparkSession) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{OPENED}`")


def _opened_name(build: Build, table: str) -> str:
    return f"`{OPENED}`.`{table.replace('.', '_')}_{build.name}`"


def _register(spark: SparkSession, name: str, build: Build, table: str) -> None:
    """Names a written table in the catalog, with its layout. The files stay where they are."""
    stored = build.tables[table]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _schema(stored).fields)
    layout = stored.layout
    buckets = ""
    if layout:
        by, order = (", ".join(f"`{c}`" for c in names) for names in (layout.buckets_by, layout.sorted_by))
        buckets = f"CLUSTERED BY ({by}) SORTED BY ({order}) INTO {layout.buckets} BUCKETS"
    place = build.path(table).replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {buckets} LOCATION '{place}'")


def _schema(stored: Stored):
    from pyspark.sql.types import StructType

    return StructType.fromJson(json.loads(stored.columns))


def read(spark: SparkSession, build: Build, table: str) -> DataFrame:
    """A table of one build, whatever the catalog names point at."""
    stored = build.tables[table]
    if stored.layout is None:
        return spark.read.schema(_schema(stored)).parquet(build.path(table))
    _database(spark)
    _register(spark, _opened_name(build, table), build, table)
    return spark.table(_opened_name(build, table))


def location(spark: SparkSession, name: str) -> str | None:
    """Folder of a catalog table; None if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else ""


def publish(spark: SparkSession, build: Build, views: dict[str, Sequence[str]] | None = None) -> None:
    """Points the catalog names at a build. `views` are names that stand for several tables: name -> tables."""
    for table in build.tables:
        where = location(spark, table)
        if where is not None and where.rstrip("/").endswith(build.tables[table].folder):
            continue
        if where is not None:
            spark.sql(f"DROP TABLE {table}")  # names the files of an earlier build, and leaves them
        _register(spark, table, build, table)
        spark.catalog.refreshTable(table)
    for name, parts in (views or {}).items():
        if location(spark, name):
            spark.sql(f"DROP TABLE {name}")  # a table of an older layout
        columns = ", ".join(f"`{f.name}`" for f in _schema(build.tables[parts[0]]).fields)
        selects = " UNION ALL ".join(f"SELECT {columns} FROM {part}" for part in parts)
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {selects}")


def discard(spark: SparkSession, build: Build) -> None:
    """Deletes what a build without a manifest has written."""
    for table, stored in build.tables.items():
        if stored.layout:
            spark.sql(f"DROP TABLE IF EXISTS {_opened_name(build, table)}")
    system, folder = files_at(spark, f"{build.root}/builds/{build.name}")
    system.delete(folder, True)


def prune(spark: SparkSession, root: str, keep: int = KEPT_BUILDS, grace_hours: float = GRACE_HOURS) -> list[str]:
    """Deletes all but the newest builds, and folders that builds lost long ago have left; returns their names.

    The manifest goes first, so no reader opens a folder that is being deleted.
    """
    root = root.rstrip("/")
    found = manifests(spark, root)
    gone = []
    for manifest in found[: max(len(found) - keep, 0)]:
        build = _load(spark, root, manifest)
        system, path = files_at(spark, f"{root}/manifests/{manifest}")
        system.delete(path, False)
        discard(spark, build)
        gone.append(build.name)
    alive = {m.split("-", 1)[1].removesuffix(".json") for m in manifests(spark, root)}
    system, folder = files_at(spark, f"{root}/builds")
    now = spark.sparkContext._jvm.java.lang.System.currentTimeMillis()
    for status in system.listStatus(folder) if system.exists(folder) else []:
        name = status.getPath().getName()
        if name not in alive and now - status.getModificationTime() > grace_hours * 3_600_000:
            discard(spark, Build(root, name))
            gone.append(name)
    return gone
