"""Repair of the structure of conversations: the cheapest edits that make the roles a legal sequence.

Turns are kept, given another role, deleted or inserted so that the roles are nothing, or a system turn at most and
then pairs of user and assistant. The cheapest edits come from a dynamic program over the four states of that
pattern, with square-root checkpoints: a backward walk stores the vector of state costs only at every so many turns;
a forward walk then computes one block of vectors after the other again and emits, of the tight edits, the ASCII-least.

A conversation of up to BLOCK turns is one such program. A longer one is cut into blocks. Each block turns the costs at its
end into those at its start by a min-plus matrix, all blocks at once; the matrices are applied from the last block
to the first, each block is walked forward from each of the four states, and the blocks are chained
from the first to the last. Texts are shuffled once, to be hashed in order; as one SHA-256 can't be split, the text of
a conversation streams through one task, batch by batch, never held whole.

Order and ties of turns: see `turns`. Null conversation ids are one conversation. Null ids and turns stand as one
space in the key of the damage, null roles and texts are one space. Empty texts are blank. Repeated rows are turns of
their own, so all but the first are duplicates. A role counts by its first character. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressure.llm.turns import conversation_rows, numbered, turn_order

# What an edit costs.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# Characters between words.
BLANKS = " \t\n\x0b\x0c\r"
STOPS = ".!?"

# Turns of one program.
BLOCK = 4096
# A turn is one letter: A, plus 4 times its initial (of INITIALS), plus its fault.
INITIALS = "sua"  # any other is 3
SOUND, BLANK, DUPLICATE, CUT = range(4)

# States: nothing yet, after system, after user, after assistant. The role an insertion or a new role gives, by state.
START, SYSTEM, USER, ASSISTANT = range(4)
GIVEN = (USER, USER, ASSISTANT, USER)
# State after keeping a turn of this initial, if that is legal.
KEPT = ({0: SYSTEM, 1: USER}, {1: USER}, {2: ASSISTANT}, {1: USER})
ROLES = {USER: "user", ASSISTANT: "assistant"}
NEVER = 1 << 40

Vector = tuple[int, ...]


def initial_of(role: str) -> int:
    return INITIALS.find(role[0]) % 4 if role else 3


def _with_insertions(costs: list[int]) -> list[int]:
    """Costs from each state when turns may be inserted first; two in a row reach every state."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[GIVEN[q]]) for q, c in enumerate(costs)]
    return costs


def _level(costs: list[int]) -> tuple[Vector, int]:
    """The costs above their least one, and that one. Levelled vectors are few, so steps on them are remembered."""
    least = min(costs)
    return tuple(c - least if c < NEVER else NEVER for c in costs), least


END = tuple(_with_insertions([0, NEVER, NEVER, 0]))


@lru_cache(1 << 16)
def _choices(letter: str, state: int) -> tuple[tuple[str, int, int], ...]:
    """(edit, cost, next state) of what may be done with this turn, ASCII-least first, insertions aside."""
    initial, fault = divmod(ord(letter) - 65, 4)
    found = [("D", DELETE, state)]
    if fault not in (BLANK, DUPLICATE):
        extra = TRUNCATED if fault == CUT else 0
        if initial in KEPT[state]:
            found.append(("K", extra, KEPT[state][initial]))
        found.append(("R", REROLE + extra, GIVEN[state]))
    return tuple(found)


@lru_cache(1 << 16)
def _back(letter: str, after: Vector) -> tuple[Vector, int]:
    """The levelled costs before a turn from those after it, and how much they rose."""
    return _level(_with_insertions([min(cost + after[to] for _, cost, to in _choices(letter, q)) for q in range(4)]))


@lru_cache(1 << 16)
def _forward(letter: str, state: int, after: Vector) -> tuple[str, int]:
    """The ASCII-least tight edits at a turn, insertions before it included, and the state after it."""
    here = _with_insertions([min(cost + after[to] for _, cost, to in _choices(letter, q)) for q in range(4)])
    edits = ""
    while True:
        tight = {edit: to for edit, cost, to in _choices(letter, state) if cost + after[to] == here[state]}
        if "D" not in tight and INSERT + here[GIVEN[state]] == here[state]:
            edits, state = edits + "I", GIVEN[state]
            continue
        edit = min(tight)
        return edits + edit, tight[edit]


def _closing(state: int) -> str:
    """The insertions after the last turn."""
    return {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[state]


def costs_before(turns: str, after: Vector) -> list[int]:
    """Costs before the first of these turns from the costs after the last."""
    shape, total = _level(list(after))
    for letter in reversed(turns):
        shape, rise = _back(letter, shape)
        total += rise
    return [min(c + total, NEVER) for c in shape]


def walk(turns: str, after: Vector, starts: tuple[int, ...] = (START,)) -> list[tuple[str, int]]:
    """The edits and last state from each of the start states: checkpoints backward, then block by block forward."""
    step = isqrt(len(turns)) + 1
    shape, _ = _level(list(after))
    checkpoints = {len(turns): shape}
    for i in range(len(turns) - 1, -1, -1):
        shape, _ = _back(turns[i], shape)
        if i % step == 0:
            checkpoints[i] = shape
    edits, states = [[] for _ in starts], list(starts)
    for a in range(0, len(turns), step):
        b = min(a + step, len(turns))
        block = [checkpoints[b]]
        for i in range(b - 1, a, -1):
            block.append(_back(turns[i], block[-1])[0])
        for i in range(a, b):
            vector = block[b - 1 - i]
            for k, state in enumerate(states):
                edit, states[k] = _forward(turns[i], state, vector)
                edits[k].append(edit)
    return [("".join(e), q) for e, q in zip(edits, states, strict=True)]


def illegal_pairs(turns: str, before: str = "") -> int:
    """Neighbours whose roles may not follow each other."""
    line = [(ord(c) - 65) // 4 for c in before[-1:] + turns]
    return sum(pair not in ((0, 1), (1, 2), (2, 1)) for pair in zip(line, line[1:]))


def repair(turns: str) -> tuple[str, int]:
    """The audit of a whole conversation, and its cost."""
    edits, state = walk(turns, END)[0]
    return edits + _closing(state), costs_before(turns, END)[START]


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after a damage that their id and turn decide: dropped, emptied, without stops, repeated, or said by the user."""
    known = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    harm = (F.crc32(F.concat(known[0], F.lit(":"), known[1]).cast("binary")) % 20).alias("_harm")
    rows = conversation_rows(conversations, " ").select("*", harm).where(F.col("_harm") != 0)
    text = F.when(F.col("_harm") == 1, "").when(F.col("_harm") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("_harm") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("_harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def _turn_letters(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, letter), duplicates found by the smallest place of each role and text of a conversation."""
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    fault = F.when(last == "", BLANK).when(last.isin(*STOPS), SOUND).otherwise(CUT)
    initial = F.coalesce(*[F.when(F.left("role", F.lit(1)) == c, i) for i, c in enumerate(INITIALS)], F.lit(3))
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    placed = numbered(rows, {"said": F.unhex(said), "initial": initial, "fault": fault})
    # Each place is first of its words once at most, so this join has no heavy key, whatever is repeated how often.
    first = placed.groupBy("conv_id", "said").agg(F.min("pos").alias("pos")).select(F.col("conv_id").alias("_conv"), F.col("pos").alias("_pos"))
    joined = placed.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("pos") == F.col("_pos")), "left")
    seen = F.when((F.col("fault") != BLANK) & F.col("_pos").isNull(), DUPLICATE).otherwise(F.col("fault"))
    return joined.select("conv_id", "pos", F.char(65 + 4 * F.col("initial") + seen).alias("letter"))


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _map(df: DataFrame, job: Callable[[Iterator[dict]], Iterator[dict]], schema: list[tuple[str, pa.DataType]]) -> DataFrame:
    """Runs `job` on the rows of each partition, one batch in memory at a time."""
    arrow = pa.schema(schema)
    names = {pa.int64(): "long", pa.string(): "string", pa.list_(pa.int64()): "array<long>", pa.list_(pa.string()): "array<string>"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(job(row for batch in batches for row in batch.to_pylist()), arrow)

    return df.mapInArrow(run, ", ".join(f"{n} {names[t]}" for n, t in schema))


_LONG, _TEXT = pa.int64(), pa.string()
_BLOCK = [("conv_id", _LONG), ("block", _LONG), ("turns", _TEXT)]
_PART = [("conv_id", _LONG), ("block", _LONG), ("audit", _TEXT), *[(c, _LONG) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]]


def _faults(turns: str) -> dict[str, int]:
    faults = [(ord(c) - 65) % 4 for c in turns]
    return {"blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(CUT)}


def _whole(rows: Iterator[dict]) -> Iterator[dict]:
    for r in rows:
        audit, cost = repair(r["turns"])
        yield {"conv_id": r["conv_id"], "block": 0, "audit": audit, "cost": cost, "illegal": illegal_pairs(r["turns"]), **_faults(r["turns"])}


def _matrices(rows: Iterator[dict]) -> Iterator[dict]:
    """Adds the block's min-plus matrix: costs before it from each state to each state after it."""
    for r in rows:
        columns = [costs_before(r["turns"], tuple(0 if q == to else NEVER for q in range(4))) for to in range(4)]
        yield r | {"matrix": [c for column in columns for c in column]}


def _costs_after(rows: Iterator[dict]) -> Iterator[dict]:
    """Blocks from the last to the first: adds the costs after each, and what is paid from the start of the conversation."""
    conv: tuple = ()
    after: list[int] = []
    for r in rows:
        if conv != (r["conv_id"],):
            conv, after = (r["conv_id"],), list(END)
        m = r.pop("matrix")
        before = [min(m[4 * to + q] + after[to] for to in range(4)) for q in range(4)]
        yield r | {"after": after, "cost": before[START]}
        after = before


def _walks(rows: Iterator[dict]) -> Iterator[dict]:
    """Walks each block forward from every state."""
    for r in rows:
        found = walk(r["turns"], tuple(r.pop("after")), (START, SYSTEM, USER, ASSISTANT))
        yield r | {"edits": [e for e, _ in found], "exits": [q for _, q in found]}


def _chained(rows: Iterator[dict]) -> Iterator[dict]:
    """Blocks from the first to the last: the edits from the state that the earlier blocks end in."""
    conv: tuple = ()
    state, before = START, ""
    held: dict | None = None
    for r in rows:
        if conv != (r["conv_id"],):
            if held is not None:
                yield held | {"audit": held["audit"] + _closing(state)}
            conv, state, before, held = (r["conv_id"],), START, "", None
        elif held is not None:
            yield held
        held = {"conv_id": r["conv_id"], "block": r["block"], "audit": r["edits"][state], "cost": 0 if r["block"] else r["cost"],
                "illegal": illegal_pairs(r["turns"], before), **_faults(r["turns"])}
        state, before = r["exits"][state], r["turns"]
    if held is not None:
        yield held | {"audit": held["audit"] + _closing(state)}


def audits(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, audit, cost, blank, duplicate, truncated, illegal) of every conversation among the rows (conv_id, turn, role, text)."""
    number = F.floor((F.col("pos") - 1) / block).cast("long")
    letters = F.array_sort(F.collect_list(F.struct("pos", "letter")))  # `block` of them at most
    blocks = (
        _turn_letters(rows).groupBy("conv_id", number.alias("block")).agg(letters.alias("_letters"))
        .select("conv_id", "block", F.concat_ws("", F.col("_letters.letter")).alias("turns"))
    )
    # Only a conversation of `block` turns or more can have a second one.
    whole = (F.col("block") == 0) & (F.length("turns") < block)
    short = _map(blocks.where(whole), _whole, _PART)
    held = _map(blocks.where(~whole), _matrices, [*_BLOCK, ("matrix", pa.list_(_LONG))])
    backward = held.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"))
    costed = _map(backward, _costs_after, [*_BLOCK, ("after", pa.list_(_LONG)), ("cost", _LONG)])
    walked = _map(costed.repartition("conv_id", "block"), _walks, [*_BLOCK, ("cost", _LONG), ("edits", pa.list_(_TEXT)), ("exits", pa.list_(_LONG))])
    long = _map(walked.repartition("conv_id").sortWithinPartitions("conv_id", "block"), _chained, _PART)
    pieces = F.array_sort(F.collect_list(F.struct("block", "audit")))
    return (
        short.unionByName(long).groupBy("conv_id")
        .agg(pieces.alias("_pieces"), *[F.sum(c).alias(c) for c in ("cost", "blank", "duplicate", "truncated", "illegal")])
        .select("*", F.concat_ws("", F.col("_pieces.audit")).alias("audit")).drop("_pieces")
    )


def repaired(audit: str) -> Callable[[Iterator[tuple[str, str]]], Iterator[tuple[str, str]]]:
    """Applies an audit to the (role, text) of its conversation's turns in order; gives those of the repaired one."""

    def apply(turns: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
        state = START
        for edit in audit:
            if edit == "I":
                state = GIVEN[state]
                yield ROLES[state], ""
                continue
            role, text = next(turns)
            if edit == "K":
                state = KEPT[state][initial_of(role)]
                yield role, text
            elif edit == "R":
                state = GIVEN[state]
                yield ROLES[state], text

    return apply


def _conversations(rows: Iterator[dict]) -> Iterator[tuple[dict, Iterator[tuple[str, str]]]]:
    """(head row, its turns) for each conversation in sorted rows; the turns are read as they are asked for."""
    ahead = next(rows, None)

    def turns() -> Iterator[tuple[str, str]]:
        nonlocal ahead
        while ahead is not None and not ahead["_head"]:
            row, ahead = ahead, next(rows, None)
            yield row["role"], row["text"]

    while ahead is not None:
        head, ahead = ahead, next(rows, None)
        own = turns()
        yield head, own
        for _ in own:  # what the reader left
            pass


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_RESULT = [("conv_id", _LONG), *[(c, _LONG) for c in _COUNTS], ("audit", _TEXT), ("repaired_sha256", _TEXT)]


def _digests(rows: Iterator[dict]) -> Iterator[dict]:
    for head, turns in _conversations(rows):
        digest, first = hashlib.sha256(), True
        for role, text in repaired(head["audit"])(turns):
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
        yield {n: head[n] for n, _ in _RESULT[:-1]} | {"repaired_sha256": digest.hexdigest()}


def repair_report(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """What is wrong with every conversation after the damage, the cheapest repair, and a digest of its result."""
    rows = damaged(conversations)
    turn = F.col("turn").cast("decimal(38,0)")
    gaps = rows.groupBy("conv_id").agg((F.max(turn) - F.min(turn) + 1 - F.count_distinct("turn")).alias("gaps"))
    found = audits(rows, block)
    ids = conversations.select(F.col("conv_id").cast("long")).distinct()

    def same(df: DataFrame) -> tuple[DataFrame, Column]:
        renamed = df.withColumnRenamed("conv_id", "_conv")
        return renamed, F.col("conv_id").eqNullSafe(F.col("_conv"))

    heads = ids.join(*same(found), "left").drop("_conv").join(*same(gaps), "left").drop("_conv")
    heads = heads.select(
        "conv_id", *[F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in _COUNTS], F.coalesce("audit", F.lit("")).alias("audit"),
        F.lit(True).alias("_head"),
    )
    both = heads.unionByName(rows.withColumn("_head", F.lit(False)), allowMissingColumns=True)
    order = [F.col("conv_id").asc_nulls_first(), F.desc("_head"), *turn_order()]
    streams = both.repartition("conv_id").sortWithinPartitions(*order).drop("turn")
    return _map(streams, _digests, _RESULT)
