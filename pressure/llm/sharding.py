"""Sharding by fixed virtual slots.

Every record hashes into one of a few thousand slots, for good. Bytes and rows are added up by
slot; a small versioned table says which shard holds which slot. The first version deals the
heaviest slots first, each to the lightest shard; later versions are edits of it: slots move only
as far as a new shard or a lopsided load asks for. Every version is stored, and records are placed by
what is read back. A record's place inside its shard follows from
the rows of the slots before its own, so no shard is ever sorted or counted in one task.

A null text has no bytes and CRC 0; an empty one likewise. Rows with null ids and repeated rows are
records of their own: copies of a row are numbered within the part of the table that a task reads, and from the second on the
number joins the hash, so that no number of copies makes a slot heavy. An empty table gives an empty result and
stores no map. Only the id and text columns are read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressure.sources.scratch import keep, new_folder

SLOTS = 4096
# Added to the bytes of every record.
OVERHEAD = 16
MAP_SCHEMA = "virtual_slot int, shard int, rows_before long, map_version int"


def records(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", slots: int = SLOTS) -> DataFrame:
    """(id, size, text_crc32, virtual_slot): what sharding needs to know of each record."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary")
    crc = F.crc32(text)
    sized = docs.select(
        F.col(id_column).alias("id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), crc.alias("text_crc32"),
        F.spark_partition_id().alias("part"),
    )
    copies = Window.partitionBy("id", "size", "text_crc32", "part").orderBy("id")
    first = F.col("nth") == 1
    # The text joins the hash so that rows that share an id, or have none, are spread as well.
    hashed = F.when(first, F.xxhash64("id", "text_crc32")).otherwise(F.xxhash64("id", "text_crc32", "nth"))
    return sized.withColumn("nth", F.row_number().over(copies)).select(
        F.col("id").alias(id_column), "size", "text_crc32", F.pmod(hashed, F.lit(slots)).cast("int").alias("virtual_slot")
    )


def slot_loads(sized: DataFrame) -> dict[int, tuple[int, int]]:
    """slot -> (bytes, rows); as many entries as there are slots at most."""
    loads = sized.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    return {r["virtual_slot"]: (r["bytes"], r["rows"]) for r in loads.collect()}


def deal(loads: dict[int, tuple[int, int]], shards: int) -> dict[int, int]:
    """First version of the map: heaviest slot first, to the shard with the fewest bytes."""
    lightest = [(0, s) for s in range(shards)]
    placed = {}
    for slot in sorted(loads, key=lambda v: (-loads[v][0], v)):
        held, shard = heapq.heappop(lightest)
        placed[slot] = shard
        heapq.heappush(lightest, (held + loads[slot][0], shard))
    return placed


def rebalance(placed: dict[int, int], loads: dict[int, tuple[int, int]], shards: int, tolerance: float = 0.02) -> dict[int, int]:
    """Next version: slots leave shards that are too heavy, or are gone, for the lightest; all others stay."""
    placed = {v: placed.get(v) for v in loads}
    held = [0] * shards
    for v, s in placed.items():
        if s is not None and s < shards:
            held[s] += loads[v][0]
    homeless = [v for v, s in placed.items() if s is None or s >= shards]
    limit = sum(b for b, _ in loads.values()) / shards * (1 + tolerance)
    for shard in range(shards):
        own = sorted((v for v, s in placed.items() if s == shard), key=lambda v: (loads[v][0], v))
        while own and held[shard] > limit:
            over = held[shard] - limit
            v = next((v for v in own if loads[v][0] >= over), own[-1])
            if loads[v][0] > 2 * over and min(held) + loads[v][0] > held[shard]:
                break  # moving it would only turn the loads around
            own.remove(v)
            held[shard] -= loads[v][0]
            homeless.append(v)
    for v in sorted(homeless, key=lambda v: (-loads[v][0], v)):
        shard = min(range(shards), key=lambda s: (held[s], s))
        placed[v] = shard
        held[shard] += loads[v][0]
    return placed


def slot_map(spark: SparkSession, placed: dict[int, int], loads: dict[int, tuple[int, int]], version: int) -> DataFrame:
    """The map as a table: slot, shard, rows of the shard that lie in slots before this one, version."""
    before: dict[int, int] = {}
    rows = []
    for v in sorted(placed):
        rows.append((v, placed[v], before.get(placed[v], 0), version))
        before[placed[v]] = before.get(placed[v], 0) + loads[v][1]
    return spark.createDataFrame(rows, MAP_SCHEMA)


def store_map(table: DataFrame, path: str) -> None:
    """Adds a version to the stored map; earlier versions stay readable."""
    table.coalesce(1).write.mode("append").partitionBy("map_version").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> tuple[DataFrame, int]:
    """The stored table of one version, or of the newest, and its version."""
    stored = spark.read.parquet(path)
    if version is None:
        version = stored.agg(F.max("map_version")).first()[0]
    return stored.where(F.col("map_version") == version).select(*stored.columns), version


def load_map(spark: SparkSession, path: str, version: int | None = None) -> tuple[dict[int, int], int]:
    """slot -> shard, of one version or the newest; as many entries as there are slots at most."""
    stored, version = read_map(spark, path, version)
    return {r["virtual_slot"]: r["shard"] for r in stored.select("virtual_slot", "shard").collect()}, version


def place(sized: DataFrame, table: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Each record with its shard and its place in it, from 0 without gaps.

    The map has at most as many rows as there are slots, so it is broadcast.
    """
    inside = Window.partitionBy("virtual_slot").orderBy(id_column, "text_crc32", "size")
    numbered = sized.withColumn("__nth", F.row_number().over(inside) - 1)
    return (
        numbered.join(F.broadcast(table), "virtual_slot")
        .withColumn("slot", (F.col("rows_before") + F.col("__nth")).cast("long"))
        .drop("__nth", "rows_before")
    )


def shard_by_bytes(
    docs: DataFrame, shards: int, id_column: str = "doc_id", text_column: str = "text", map_path: str | None = None, edit: bool = False
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version): shards of near equal bytes.

    The map is stored at map_path, in a new folder by default. With `edit`, a map stored there before is rebalanced to the
    table's loads and to the number of shards, and stored as the next version; without, the first version is dealt.
    """
    spark = docs.sparkSession
    sized = keep(records(docs, id_column, text_column), "sharding")
    loads = slot_loads(sized)
    path = map_path or new_folder(spark, "slot-map")
    if edit:
        stored, version = load_map(spark, path)
        placed, version = rebalance(stored, loads, shards), version + 1
    else:
        placed, version = deal(loads, shards), 1
    table = slot_map(spark, placed, loads, version)
    if loads:
        store_map(table, path)
        table, _ = read_map(spark, path, version)
    return place(sized, table, id_column).select(
        id_column, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version",
    )
