from __future__ import annotations

import hashlib
import random
import zlib

from pressure.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    """The trie by a dictionary of whole prefixes."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [r[2:] for r in sorted(t)] for c, t in own.items()}
    built = {}
    for c, t in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        family = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = tuple(turns.get(family, [])[:h] + t[h:])
    members = {}
    for c, t in built.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[x] for x in below) if below else 1
        saved[p] = sum(saved[x] for x in below) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    out = []
    for p, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(built[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(who), len(p), parent, len(who), len(children.get(p, [])), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert result(trie.prefix_trie(df)) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def odd_rows():
    rng = random.Random(3)
    roles, texts = [None, "user", "assistant"], [None, "", "Yes.", "é…", "x" * 100]
    rows = [(c, t, rng.choice(roles), rng.choice(texts)) for c in [None, -205, -200, -3, 0, 2**41, *range(100, 140), 700] for t in [None, *range(rng.randint(1, 9))]]
    rows += [(c, t, "user", f"turn {t}") for c in range(200, 260) for t in range(12)]  # copies
    rows += [(c, t, "user", f"turn {t}") for c in (300, 301, 317, 5000) for t in range(90 + c % 7)]  # long ones that part late
    rows += [(401, 0, "user", "no head of the family"), (401, 1, "user", "b"), (402, 0, "x", "y"), (404, 5, "x", "y")]
    return rows + rows[:30] + [(900, 1, "user", "again")] * 2000


def test_odd_rows(spark):
    rows = odd_rows()
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as pos", "2 as a", "3 as band", "4 as kind", "5 as shard", "6 as family", "'x' as chars")
    expected = brute(rows)
    assert result(trie.prefix_trie(df)) == expected


def test_small_shards_and_bands_give_the_same(spark):
    rows = [r for r in odd_rows() if r[0] != 900]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(trie.prefix_trie(df, ids=20, band=8)) == brute(rows)


def test_no_rows(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "a")], SCHEMA)).collect() == []
