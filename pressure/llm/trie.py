"""Prefix trie of conversations from vertical bitmaps.

Conversations that begin alike share nodes: the node of depth d stands for one sequence of d turns, its members are
the conversations that start with it. A shard holds SHARD_IDS neighbouring ids. It indexes (position, turn) to the
bitset of its conversations with that turn there; walking depth first, a node's bitset is intersected with the postings of
the next position: what is not empty is a child, its popcount the child's members, and members whose turns end
here are the node's end list. Nodes of all shards are then added up by depth and prefix.

A conversation of more than BAND_TURNS turns is cut into bands of positions, each a shard of its own that starts from the
prefixes of its conversations, so a task holds SHARD_IDS * BAND_TURNS turns at most, whatever one
conversation or one prefix is shared by. A prefix is known by the exclusive or of two 64-bit hashes of each position and
turn, a turn by 128 bits of the SHA-256 of its role and text. Sums over subtrees take a second walk: every node's own value is laid on its
smallest member, and each shard adds up the values of the members of its nodes.

Order and ties of turns: see `turns`. Rows without a conversation id take no part. Null roles and texts are empty ones.
Repeated rows are turns of their own. An empty table gives no nodes, not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressure.llm.turns import conversation_rows, numbered
from pressure.sources.scratch import keep, keep_counted

# Fixed values of the rebuilding: ids of one family, and how many numbers of shared turns there are.
FAMILY, SHARED = 100, 6
SHARD_IDS, BAND_TURNS = 512, 512
# A parent of more than one in so many nodes is heavy: there are fewer of those than this.
HEAVY = 1000
# Parts over which the rows that look up a family are spread.
SALTS = 16

# Kinds of row that a shard reads, in this order for each conversation.
ENTRY, TURN, FINISH, VALUE, LATER = range(5)


def _family(conv: Column) -> Column:
    return conv - conv % FAMILY


def _borrowed(conv: Column) -> Column:
    """How many turns a conversation takes from the first one of its family."""
    return F.crc32(conv.cast("string").cast("binary")) % SHARED


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn, chars): every turn at its place, its role and text as 128 bits."""
    rows = conversation_rows(conversations, "").where(F.col("conv_id").isNotNull())
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    return numbered(rows, {"turn": F.unhex(F.left(said, F.lit(32))), "chars": F.length("text")})


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn, chars) of the rebuilt conversations, and one row without a turn at the place after their last.

    The turns are those of the family's first conversation, as many as are borrowed, then the own ones after as many.
    """
    rows = keep(turn_rows(conversations), "placed-turns").withColumn("borrowed", _borrowed(F.col("conv_id")))
    head = rows.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < SHARED))
    head = head.select(F.col("conv_id").alias("family"), F.col("pos"), "turn", "chars")
    heads = head.groupBy("family").agg(F.max("pos").alias("there"))
    family = _family(F.col("conv_id")).alias("family")
    ids = rows.groupBy("conv_id").agg(F.max("pos").alias("own")).select("*", family, _borrowed(F.col("conv_id")).alias("borrowed"))
    taken = F.least("borrowed", F.coalesce("there", F.lit(0)))

    # A family's row is copied for each salt, so that the turns of a long conversation do not meet in one task.
    salted = heads.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = (
        rows.where(F.col("pos") > F.col("borrowed")).select("*", family, (F.col("pos") % SALTS).cast("int").alias("salt"))
        .join(salted, ["family", "salt"], "left")
        .select("conv_id", (F.col("pos") - F.col("borrowed") + taken).alias("pos"), "turn", "chars")
    )
    first = ids.select("conv_id", "family", "borrowed").join(head, "family").where(F.col("pos") <= F.col("borrowed"))
    finish = ids.join(heads, "family", "left").select(
        "conv_id", (F.greatest(F.col("own") - F.col("borrowed"), F.lit(0)) + taken + 1).alias("pos"),
        F.lit(None).cast("binary").alias("turn"), F.lit(0).alias("chars"),
    )
    return own.unionByName(first.select("conv_id", "pos", "turn", "chars")).unionByName(finish)


def _band(pos: Column, turns: int) -> Column:
    return F.floor((pos - 1) / turns).cast("long")


def shard_rows(conversations: DataFrame, band: int = BAND_TURNS) -> DataFrame:
    """(conv_id, band, pos, kind, a, b, chars): turns, ends, and the prefix with which a conversation enters a band after its first."""
    hashes = [F.when(F.col("turn").isNotNull(), h).otherwise(0) for h in (F.xxhash64("pos", "turn"), F.xxhash64("turn", "pos", F.lit(13)))]
    kind = F.when(F.col("turn").isNull(), FINISH).otherwise(TURN)
    rows = rebuilt(conversations).select(
        "conv_id", _band(F.col("pos"), band).alias("band"), "pos", kind.alias("kind"), hashes[0].alias("a"), hashes[1].alias("b"), F.col("chars").cast("long")
    )
    rows = keep(rows, "shard-rows")
    return rows.unionByName(_entries(rows, band))


def _entries(rows: DataFrame, band: int) -> DataFrame:
    parts = rows.groupBy("conv_id", "band").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    earlier = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    prefixes = parts.select("conv_id", "band", *[F.bit_xor(c).over(earlier).alias(c) for c in ("a", "b")])
    return prefixes.where(F.col("band") > 0).select(
        "conv_id", "band", (F.col("band") * band).alias("pos"), F.lit(ENTRY).alias("kind"), "a", "b", F.lit(0).cast("long").alias("chars")
    )


class Shard:
    """One band of the conversations of one shard, sorted by id: bit i stands for the i-th of them."""

    def __init__(self, columns: dict[str, np.ndarray], top: int):
        self.ids, conv = np.unique(columns["conv_id"], return_inverse=True)
        self.top = top  # depth of the nodes that the walk starts from
        n = len(self.ids)
        self.turns: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        self.chars: list[list[int]] = [[] for _ in range(n)]
        self.entry = [(0, 0)] * n
        self.finish: dict[int, int] = {}
        self.postings: dict[tuple, int] = {}
        self.values: dict[tuple[int, int], int] = {}
        self.leaf: dict[tuple[int, int], int] = {}
        self.later: dict[int, tuple[int, int]] = {}
        for i, pos, kind, a, b, chars in zip(conv.tolist(), *[columns[c].tolist() for c in ("pos", "kind", "a", "b", "chars")], strict=True):
            if kind == TURN:
                self.turns[i].append((a, b))
                self.chars[i].append(chars)
                key = (pos, a, b)
                self.postings[key] = self.postings.get(key, 0) | 1 << i
            elif kind == FINISH:
                self.finish[pos - 1] = self.finish.get(pos - 1, 0) | 1 << i
            elif kind == ENTRY:
                self.entry[i] = (a, b)
            elif kind == VALUE:
                self.values[i, pos], self.leaf[i, pos] = a, b
            else:
                self.later[i] = (a, b)

    def nodes(self) -> Iterator[tuple[int, int, tuple[int, int], tuple[int, int], int, int, int]]:
        """(parent's number, depth, prefix, parent's prefix, bitset, ends, code points) depth first; starts have no parent (-1)."""
        starts: dict[tuple[int, int], int] = {}
        for i, prefix in enumerate(self.entry):
            starts[prefix] = starts.get(prefix, 0) | 1 << i
        stack = [(-1, self.top, prefix, prefix, bits, 0) for prefix, bits in starts.items()]
        number = -1
        while stack:
            parent, depth, prefix, above, bits, chars = stack.pop()
            number += 1
            ends = bits & self.finish.get(depth, 0)
            yield parent, depth, prefix, above, bits, ends, chars
            going, at = bits & ~ends, depth - self.top
            while going:
                i = (going & -going).bit_length() - 1
                if len(self.turns[i]) <= at:  # it goes on in the next band
                    going &= ~(1 << i)
                    continue
                turn = self.turns[i][at]
                child = bits & self.postings[depth + 1, *turn]
                going &= ~child
                stack.append((number, depth + 1, (prefix[0] ^ turn[0], prefix[1] ^ turn[1]), prefix, child, self.chars[i][at]))

    def members(self, bits: int) -> Iterator[int]:
        while bits:
            i = (bits & -bits).bit_length() - 1
            bits &= bits - 1
            yield i


_LONG = pa.int64()
_NODE = pa.schema([*[(c, _LONG) for c in ("shard", "depth", "a", "b", "above_a", "above_b", "conv_id", "n_convs", "chars", "n_ends")], ("ends", pa.string())])
_SUMS = pa.schema([(c, _LONG) for c in ("depth", "a", "b", "n_leaves", "saved_tokens")])


def _node_rows(shard: Shard, number: int) -> Iterator[dict]:
    for parent, depth, prefix, above, bits, ends, chars in shard.nodes():
        again = parent < 0 and depth > 0  # the band before counts its members
        if again and not ends:
            continue
        first = int(shard.ids[(bits & -bits).bit_length() - 1])
        listed = ",".join(str(shard.ids[i]) for i in shard.members(ends)) if ends else None
        yield {"shard": number, "depth": depth, "a": prefix[0], "b": prefix[1], "above_a": None if again else above[0], "above_b": None if again else above[1],
               "conv_id": first, "n_convs": 0 if again else bits.bit_count(), "chars": chars, "n_ends": ends.bit_count(), "ends": listed}


def _sum_rows(shard: Shard, band: int) -> Iterator[dict]:
    """Adds every node's own value, and what its members hold in later bands, to all nodes above."""
    walked = list(shard.nodes())
    saved, leaves = [0] * len(walked), [0] * len(walked)
    last = shard.top + band
    for k in range(len(walked) - 1, -1, -1):
        parent, depth, _, _, bits, _, _ = walked[k]
        low = (bits & -bits).bit_length() - 1
        saved[k] += shard.values.get((low, depth), 0)
        leaves[k] += shard.leaf.get((low, depth), 0)
        if depth == last and shard.later:
            for i in shard.members(bits):
                more = shard.later.get(i, (0, 0))
                saved[k] += more[0]
                leaves[k] += more[1]
        if parent >= 0:
            saved[parent] += saved[k]
            leaves[parent] += leaves[k]
    for k, (parent, depth, prefix, *_) in enumerate(walked):
        if (parent >= 0 or depth == 0) and (saved[k] or leaves[k]):
            yield {"depth": depth, "a": prefix[0], "b": prefix[1], "n_leaves": leaves[k], "saved_tokens": saved[k]}


def _per_shard(rows: DataFrame, job: Callable[[Shard, int], Iterator[dict]], schema: pa.Schema, ids: int, band: int) -> DataFrame:
    """Runs `job` on every shard and band. The rows of one are together after the sort, so one at a time is in memory."""
    names = [*rows.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        key: tuple = ()

        def done() -> Iterator[pa.RecordBatch]:
            if held:
                shard = Shard({c: np.concatenate([h[c] for h in held]) for c in names}, key[1] * band)
                found = []
                for row in job(shard, key[0]):
                    found.append(row)
                    if len(found) == 4096:
                        yield pa.RecordBatch.from_pylist(found, schema)
                        found = []
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema)
            held.clear()

        for batch in batches:
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in (*names, "shard")}
            new = np.flatnonzero((np.diff(columns["shard"]) != 0) | (np.diff(columns["band"]) != 0)) + 1
            for a, b in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows], strict=True):
                if a == b:
                    continue
                own = (int(columns["shard"][a]), int(columns["band"][a]))
                if own != key:
                    yield from done()
                    key = own
                held.append({c: columns[c][a:b] for c in names})
        yield from done()

    number = F.expr(f"conv_id DIV {ids}")  # follows the ids; the shard around 0 has up to twice as many
    sharded = rows.select("*", number.alias("shard")).repartition("shard", "band")
    sharded = sharded.sortWithinPartitions("shard", "band", "conv_id", "pos", "kind")
    types = {pa.int64(): "long", pa.string(): "string"}
    return sharded.mapInArrow(run, ", ".join(f"{f.name} {types[f.type]}" for f in schema))


def _end_digests(parts: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): the end lists of each node, shard after shard, through one digest; none is held whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, hashlib.sha256()
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                own = (row["depth"], row["a"], row["b"])
                if own != key:
                    if key is not None:
                        found.append((*key, digest.hexdigest()))
                    key, digest = own, hashlib.sha256(row["ends"].encode())
                else:
                    digest.update(f",{row['ends']}".encode())
            yield out(found)
        if key is not None:
            yield out([(*key, digest.hexdigest())])

    def out(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, f, strict=True)) for f in found], schema)

    schema = pa.schema([("depth", _LONG), ("a", _LONG), ("b", _LONG), ("ends_sha256", pa.string())])
    lists = parts.where(F.col("ends").isNotNull()).select("depth", "a", "b", "shard", "ends")
    lists = lists.repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "shard")
    return lists.mapInArrow(run, "depth long, a long, b long, ends_sha256 string")


def _marks(nodes: DataFrame, rows: DataFrame, band: int) -> DataFrame:
    """The nodes' own values and whether they are leaves, laid on their smallest members: at their depths, and for the bands before."""
    value = (F.col("n_convs") - 1) * F.col("chars")
    leaf = (F.col("n_convs") == F.col("n_ends")).cast("long")
    # A node belongs to the band that counts its members; the root to the first.
    at = F.greatest(_band(F.col("depth"), band), F.lit(0)).cast("long")
    own = nodes.select("conv_id", at.alias("band"), F.col("depth").alias("pos"), value.alias("a"), leaf.alias("b"))
    own = own.where((F.col("a") != 0) | (F.col("b") != 0))
    bands = rows.where(F.col("kind") == ENTRY).select("conv_id", F.col("band") - 1, F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    sums = own.select("conv_id", "band", "a", "b").unionAll(bands).groupBy("conv_id", "band").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    after = Window.partitionBy("conv_id").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    later = sums.select("conv_id", "band", F.lit(0).cast("long").alias("pos"), *[F.sum(c).over(after).alias(c) for c in ("a", "b")])
    later = later.where((F.col("a") != 0) | (F.col("b") != 0))
    kinds = [own.withColumn("kind", F.lit(VALUE)), later.withColumn("kind", F.lit(LATER))]
    return kinds[0].unionByName(kinds[1]).withColumn("chars", F.lit(0).cast("long"))


def _with_parents(nodes: DataFrame, count: int) -> DataFrame:
    """Adds parent_conv_id. Nodes of a heavy parent look it up in a table of fewer than HEAVY rows, the others by a join."""
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("above_a"), F.col("b").alias("above_b"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    key = ["depth", "above_a", "above_b"]
    is_heavy = F.col("n_children") * HEAVY > count
    heavy = nodes.join(F.broadcast(up.where(is_heavy).drop("n_children").withColumnRenamed("parent_conv_id", "_heavy")), key, "left")
    rest = heavy.where(F.col("_heavy").isNull()).drop("_heavy").join(up.where(~is_heavy).drop("n_children"), key, "left")
    return heavy.where(F.col("_heavy").isNotNull()).withColumnRenamed("_heavy", "parent_conv_id").unionByName(rest)


def prefix_trie(conversations: DataFrame, ids: int = SHARD_IDS, band: int = BAND_TURNS) -> DataFrame:
    """One row per node: its smallest member and depth, its parent, members, children, leaves, what sharing saves, and its end list's digest."""
    rows = shard_rows(conversations, band)
    parts = keep(_per_shard(rows, _node_rows, _NODE, ids, band), "trie-parts")
    key = ["depth", "a", "b"]
    merged = parts.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_ends").alias("n_ends"),
        F.max("chars").alias("chars"), F.max("above_a").alias("above_a"), F.max("above_b").alias("above_b"),
    )
    children = merged.where(F.col("depth") > 0).groupBy((F.col("depth") - 1).alias("depth"), F.col("above_a").alias("a"), F.col("above_b").alias("b"))
    merged = merged.join(children.agg(F.count("*").alias("n_children")), key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes, count = keep_counted(merged, "trie-nodes")

    marked = rows.unionByName(_marks(nodes, rows, band).select(*rows.columns))
    sums = _per_shard(marked, lambda shard, _: _sum_rows(shard, band), _SUMS, ids, band)
    sums = sums.groupBy(*key).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    nothing = hashlib.sha256().hexdigest()
    return (
        _with_parents(nodes, count).join(sums, key, "left").join(_end_digests(parts), key, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(0).cast("long")).alias("n_leaves"),
            F.coalesce("saved_tokens", F.lit(0).cast("long")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )
