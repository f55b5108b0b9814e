from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from pressure.llm import structure

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def cheapest(turns: str) -> tuple[int, str]:
    """Forward search over (place, state), whole audits compared as strings."""
    n = len(turns)
    best = {(0, 0): (0, "")}
    for i in range(n + 1):
        for _ in range(3):  # insertions
            for q in range(4):
                if (i, q) in best:
                    cost, audit = best[i, q]
                    to = (i, structure.GIVEN[q])
                    best[to] = min(best.get(to, (10**9, "")), (cost + 3, audit + "I"))
        if i == n:
            break
        initial, fault = divmod(ord(turns[i]) - 65, 4)
        for q in range(4):
            if (i, q) not in best:
                continue
            cost, audit = best[i, q]
            moves = [(4, "D", q)]
            if fault in (0, 3):
                extra = 3 if fault == 3 else 0
                legal = {"0s": 1, "0u": 2, "1u": 2, "2a": 3, "3u": 2}.get(f"{q}{'suax'[initial]}")
                if legal:
                    moves.append((extra, "K", legal))
                moves.append((3 + extra, "R", structure.GIVEN[q]))
            for price, edit, to in moves:
                best[i + 1, to] = min(best.get((i + 1, to), (10**9, "")), (cost + price, audit + edit))
    return min(best[n, q] for q in (0, 3) if (n, q) in best)


LETTERS = [chr(65 + i) for i in range(16)]


def test_every_short_conversation_has_the_cheapest_least_audit():
    for n in range(4):
        for turns in product(LETTERS, repeat=n):
            audit, cost = structure.repair("".join(turns))
            assert (cost, audit) == cheapest("".join(turns))


@pytest.mark.parametrize("seed", range(30))
def test_long_conversations(seed):
    rng = random.Random(seed)
    turns = "".join(rng.choices(LETTERS, [1, 1, 1, 1, 6, 1, 1, 1, 6, 1, 1, 1, 1, 1, 1, 1], k=rng.randint(4, 60)))
    audit, cost = structure.repair(turns)
    assert (cost, audit) == cheapest(turns)


def brute(rows):
    """The whole report in plain Python: {conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha)}."""
    out, kept = {}, {}
    for conv, turn, role, text in rows:
        kept.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        row = (turn, "user" if harm == 4 else role, text)
        kept[conv] += [row] * (2 if harm == 3 else 1)
    for conv, own in kept.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        known = [r[0] for r in own if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        letters, seen = "", set()
        for _, role, text in own:
            bare = text.strip(SPACE)
            fault = 1 if not bare else 2 if (role, text) in seen else 0 if bare[-1] in ".!?" else 3
            seen.add((role, text))
            letters += chr(65 + 4 * ("sua".find(role[0]) % 4 if role else 3) + fault)
        faults = [(ord(c) - 65) % 4 for c in letters]
        firsts = [r[1][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))
        cost, audit = cheapest(letters)
        turns, lines, state = iter(own), [], 0
        for edit in audit:
            if edit == "I":
                state = structure.GIVEN[state]
                lines.append({2: "user:", 3: "assistant:"}[state])
                continue
            _, role, text = next(turns)
            if edit == "K":
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
                lines.append(f"{role}:{text}")
            elif edit == "R":
                state = structure.GIVEN[state]
                lines.append({2: "user:", 3: "assistant:"}[state] + text)
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, sha)
    return out


def result(df):
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in rows}


def test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    found = result(structure.repair_report(df))
    assert found == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    assert all(re.fullmatch("[DIKR]*", r[6]) for r in found.values())


def odd_rows():
    rng = random.Random(5)
    roles = [None, "", "user", "assistant", "system", "tool", "User", "üser"]
    texts = [None, "", " \n", "Yes.", "No", "Why?!  \t", "x" * 70 + "a.", "x" * 70 + "b.", "é…", "Hm ", "a" * 30000 + "."]
    rows = []
    for conv in [None, -7, 0, 1, 2, 3, 4, 2**40]:
        for _ in range(rng.randint(1, 25)):
            rows.append((conv, rng.choice([None, *range(12), 1000]), rng.choice(roles), rng.choice(texts)))
    return rows + rows[:40] + [(99, 3, "user", "All the same.")] * 3000


def test_odd_rows_and_blocks(spark):
    rows = odd_rows()
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as pos", "2 as letter", "'x' as audit", "3 as block", "4 as _head", "5 as cost")
    expected = brute(rows)
    assert result(structure.repair_report(df)) == expected
    # Cut into many small blocks, the long conversations give the same.
    assert result(structure.repair_report(df, 7)) == expected


def test_every_row_dropped_and_empty_table(spark):
    gone = next((c, t) for c in range(100) for t in range(10) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    found = result(structure.repair_report(spark.createDataFrame([(*gone, "user", "Hi.")], SCHEMA)))
    assert found == {gone[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert structure.repair_report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_places_are_the_same_over_many_ranges(spark):
    from pyspark.sql import functions as F

    from pressure.llm.turns import conversation_rows, numbered

    rows = spark.createDataFrame(odd_rows(), SCHEMA).repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = numbered(conversation_rows(rows, " "), {"turn": F.col("turn"), "role": F.col("role"), "text": F.col("text")}).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    by_conv = {}
    for r in got:
        by_conv.setdefault(r["conv_id"], []).append((r["pos"], r["turn"] is not None, r["turn"] or 0, r["role"]))
    assert sum(map(len, by_conv.values())) == len(odd_rows())
    for places in by_conv.values():
        places.sort()
        assert [p[0] for p in places] == list(range(1, len(places) + 1))
        assert [p[1:] for p in places] == sorted(p[1:] for p in places)
