"""Byte-level BPE encoding and decoding.

Texts are cut into pieces without a regular expression. Every code point gets a class from an
array; class and next characters give one of 16 symbols; a symbol is a function from the states
of a small automaton to its states. Such functions compose associatively, so the state at every
character comes from a blocked prefix scan over their product table, and a piece starts where the
automaton says so. Pieces are merged pair by pair, lowest rank first, and remembered; every token
keeps the byte offset at which it ends, so that any run of tokens can be decoded alone.

Null text counts as empty; an empty text has no tokens. Rows are handled one by one, so repeated
rows, ties and empty tables need no rule. Only the id and text columns are read.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressure.llm.common import shared, slices, spread

LETTER, NUMBER, OTHER, WHITE, SPACE, QUOTE = range(6)
# The characters with the White_Space property.
WHITE_SPACE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# What may follow an apostrophe at the start of a piece.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")

# Symbols: white space followed by none ends a run of it; a blank there joins the next piece.
S_LETTER, S_NUMBER, S_OTHER, S_WHITE, S_WHITE_LAST, S_SPACE_LAST, S_SHORT, S_LONG = range(8)
# States: what the piece that holds the last character is; FRESH: the next character starts one.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_WHITE, AT_SPACE, ONE_LEFT, TWO_LEFT = range(8)
# Pieces remembered by a worker before it forgets them all; longer pieces are not remembered.
REMEMBERED, REMEMBERED_BYTES = 400_000, 64
# Pieces up to so many bytes are merged by a plain scan, longer ones with a heap.
SHORT = 48


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[WHITE_SPACE] = WHITE
    out[0x20] = SPACE
    out[0x27] = QUOTE
    return out


@lru_cache(1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(element of each symbol, product table, state that an element gives from FRESH..., starts).

    Symbols 8 to 15 are 0 to 7 at the start of a text: they act as from FRESH in any state.
    """
    step = np.zeros((8, 8), np.int64)
    start = np.ones((8, 8), bool)
    run = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS, S_OTHER: IN_OTHERS, S_WHITE: IN_WHITE}
    for symbol, state in run.items():
        step[:, symbol] = state
        start[state, symbol] = False
    step[:, S_WHITE_LAST], step[:, S_SPACE_LAST] = FRESH, AT_SPACE
    step[:, S_SHORT], step[:, S_LONG] = ONE_LEFT, TWO_LEFT
    for symbol in (S_LETTER, S_NUMBER, S_OTHER):
        start[AT_SPACE, symbol] = False
    for symbol in (S_SHORT, S_LONG):  # an apostrophe inside a run of its class is one of the run
        for state in (IN_OTHERS, AT_SPACE):
            step[state, symbol], start[state, symbol] = IN_OTHERS, False
    step[ONE_LEFT, S_LETTER], start[ONE_LEFT, S_LETTER] = FRESH, False
    step[TWO_LEFT, S_LETTER], start[TWO_LEFT, S_LETTER] = ONE_LEFT, False

    symbols = [tuple(step[:, s]) for s in range(8)] + [(int(step[FRESH, s]),) * 8 for s in range(8)]
    identity = tuple(range(8))
    elements = {identity: 0}
    order = [identity]
    for e in order:  # grows until every product is known
        for s in symbols:
            made = tuple(int(s[x]) for x in e)
            if made not in elements:
                elements[made] = len(order)
                order.append(made)
    product = np.array([[elements[tuple(b[x] for x in a)] for b in order] for a in order], np.uint16)
    starts = np.concatenate([start, np.repeat(start[FRESH][None], 8, 0)], axis=1)
    return np.array([elements[tuple(int(x) for x in s)] for s in symbols], np.uint16), product, np.array(order, np.uint8), starts


def piece_starts(code: np.ndarray, first: np.ndarray, block: int = 256) -> np.ndarray:
    """Positions where pieces start; `first` has the positions where non-empty texts start."""
    n = len(code)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[code]
    last = np.zeros(n, bool)
    last[first[1:] - 1] = True
    last[-1] = True
    white = (kind == WHITE) | (kind == SPACE)
    before_text = white & ~last
    before_text[:-1] &= ~white[1:]
    symbol = np.minimum(kind, S_WHITE)
    symbol[kind == QUOTE] = S_OTHER
    symbol[before_text] = S_WHITE_LAST
    symbol[before_text & (kind == SPACE)] = S_SPACE_LAST
    quotes = np.flatnonzero((kind == QUOTE) & ~last)
    one = code[quotes + 1]
    two = np.where(last[quotes + 1], 0, code[np.minimum(quotes + 2, n - 1)])
    symbol[quotes[np.isin(one, [ord(c) for c in ONE_LETTER])]] = S_SHORT
    for a, b in TWO_LETTERS:
        symbol[quotes[(one == ord(a)) & (two == ord(b))]] = S_LONG
    symbol[first] += 8

    of_symbol, product, states, starts = automaton()
    size = len(product)
    flat = product.ravel()
    rows = -(-n // block)
    padded = np.zeros(rows * block, np.uint16)
    padded[:n] = of_symbol[symbol]
    columns = np.ascontiguousarray(padded.reshape(rows, block).T)
    for j in range(1, block):  # prefix products inside every block, all blocks at once
        columns[j] = flat[columns[j - 1].astype(np.int32) * size + columns[j]]
    whole = columns[-1].copy()
    d = 1
    while d < rows:  # prefix products over the blocks
        whole[d:] = flat[whole[:-d].astype(np.int32) * size + whole[d:]]
        d *= 2
    entered = np.zeros(rows, np.uint8)
    entered[1:] = states[whole[:-1], FRESH]
    after = states[columns, entered[None, :]].T.ravel()[:n]
    before = np.empty(n, np.uint8)
    before[0], before[1:] = FRESH, after[:-1]
    return np.flatnonzero(starts[before, symbol])


def _merged_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    parts = [piece[i : i + 1] for i in range(len(piece))]
    none = len(ranks) << 1
    pairs = [ranks.get(a + b, none) for a, b in zip(parts[:-1], parts[1:], strict=True)]
    while pairs and (lowest := min(pairs)) < none:
        i = pairs.index(lowest)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece: the adjacent pair of lowest rank, leftmost first, is joined until none has a rank."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    if n <= SHORT:
        return _merged_short(piece, ranks)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    waiting = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(waiting)
    while waiting:
        _, i, stop = heapq.heappop(waiting)
        j = after[i] if end[i] else n
        if j >= n or end[j] != stop:
            continue  # one side has been joined meanwhile
        end[i], end[j], after[i] = stop, 0, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(piece[i : end[after[i]]])) is not None:
                heapq.heappush(waiting, (r, i, end[after[i]]))
        if (h := before[i]) >= 0 and (r := ranks.get(piece[h:stop])) is not None:
            heapq.heappush(waiting, (r, h, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = after[i]
    return out


class Encoder(dict):
    """Piece -> its number; the ids of all numbered pieces lie one after the other."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        self.sizes[list(ranks.values())] = [len(t) for t in ranks]
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.ids: list[int] = []
        self.lengths: list[int] = []
        self._arrays = (np.zeros(0, np.uint32), np.zeros(0, np.int64))

    def __missing__(self, piece: bytes) -> int:
        ids = merged(piece, self.ranks)
        self.ids += ids
        self.lengths.append(len(ids))
        number = len(self.lengths) - 1
        if len(piece) <= REMEMBERED_BYTES:
            self[piece] = number
        return number

    def _known(self) -> tuple[np.ndarray, np.ndarray]:
        ids, lengths = self._arrays
        if len(lengths) < len(self.lengths):
            self._arrays = (
                np.concatenate([ids, np.array(self.ids[len(ids) :], np.uint32)]),
                np.concatenate([lengths, np.array(self.lengths[len(lengths) :], np.int64)]),
            )
        return self._arrays

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, the byte offset inside its text where each token ends, and the tokens of each text."""
        if len(self.lengths) > REMEMBERED:
            self.forget()
        joined = "".join(texts)
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        data = joined.encode("utf-8")
        chars = np.fromiter(map(len, texts), np.int64, len(texts))
        text_start = np.cumsum(chars) - chars
        start = piece_starts(code, text_start[chars > 0])
        if len(data) == len(code):
            byte_at = np.arange(len(code) + 1)
        else:
            byte_at = np.zeros(len(code) + 1, np.int64)
            np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), out=byte_at[1:])
        cut = np.append(byte_at[start], len(data)).tolist()
        number = np.fromiter((self[data[a:b]] for a, b in zip(cut[:-1], cut[1:], strict=True)), np.int64, len(start))
        ids, lengths = self._known()
        per_piece = lengths[number]
        tokens = ids[spread((np.cumsum(lengths) - lengths)[number], per_piece)]
        total = np.concatenate([[0], np.cumsum(per_piece)])
        upto = total[np.searchsorted(start, np.append(text_start, len(code)))]
        per_text = np.diff(upto)
        ends = np.cumsum(self.sizes[tokens]) - np.repeat(byte_at[text_start], per_text)
        return tokens, ends, per_text


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        by_id = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            by_id[i] = token
        self.sizes = np.array([len(t) for t in by_id], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(by_id), np.uint8)

    def decode(self, ids: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all texts, and how many are each text's."""
        sizes = self.sizes[ids]
        total = np.concatenate([[0], np.cumsum(sizes)])
        upto = total[np.concatenate([[0], np.cumsum(per_text)])]
        return self.data[spread(self.starts[ids], sizes)], np.diff(upto)


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


_MADE: dict[tuple[type, int], Encoder | Decoder] = {}


def _worker(kind: type, vocabulary) -> Encoder | Decoder:
    """Made once in a Python worker, with what it remembers."""
    data = vocabulary.value
    key = (kind, hash(data))
    if key not in _MADE:
        _MADE[key] = kind(read_ranks(data))
    return _MADE[key]


def _packed(values: np.ndarray, per_row: np.ndarray) -> pa.Array:
    """Rows of bytes cut from one array."""
    ends = np.concatenate([[0], np.cumsum(per_row * values.itemsize)])
    return pa.Array.from_buffers(
        pa.large_binary(), len(per_row), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(np.ascontiguousarray(values))]
    ).cast(pa.binary())


def _lists(values: np.ndarray, per_row: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def read_vocabulary(path: str) -> bytes:
    """A rank file: one token in base64 and its rank on a line. Read on the driver, sent to the tasks."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, vocabulary: bytes, id_column: str = "doc_id", text_column: str = "text", packed: bool = False) -> DataFrame:
    """(id, n_tokens long, ids, ends): token ids of each whole text, and the byte offset where each token ends.

    As arrays of int, or `packed` as little-endian unsigned 32-bit integers in bytes.
    """
    sent = shared(docs.sparkSession, vocabulary)
    shape = _packed if packed else _lists

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker(Encoder, sent)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(np.fromiter(map(len, texts), np.int64, len(texts))):
                ids, ends, per_text = encoder.encode(texts[a:b])
                columns = [shape(ids.astype("<u4"), per_text), shape(ends.astype("<u4"), per_text)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.array(per_text), *columns], [id_column, "n_tokens", "ids", "ends"]
                )

    kept = docs.select(F.col(id_column), F.col(text_column).cast("string").alias("__text"))
    kind = "binary" if packed else "array<int>"
    id_type = docs.schema[id_column].dataType.simpleString()
    return kept.mapInArrow(run, f"`{id_column}` {id_type}, n_tokens long, ids {kind}, ends {kind}")


def decode(encoded: DataFrame, vocabulary: bytes, ids_column: str = "ids") -> DataFrame:
    """All columns but the ids, and `decoded` binary: the bytes that the ids (array or packed) stand for; null ids: empty."""
    sent = shared(encoded.sparkSession, vocabulary)
    rest = [c for c in encoded.columns if c not in (ids_column, "decoded")]
    schema = [f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _worker(Decoder, sent)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            is_packed = not pa.types.is_list(column.type)
            rows = column.to_pylist()
            ids = [np.frombuffer(x or b"", "<u4") if is_packed else np.array(x or [], np.uint32) for x in rows]
            counts = np.fromiter(map(len, ids), np.int64, len(ids))
            for a, b in slices(counts, 1 << 18):
                data, sizes = decoder.decode(np.concatenate(ids[a:b]).astype(np.int64), counts[a:b])
                kept = [batch.column(i)[a:b] for i in range(len(rest))]
                yield pa.RecordBatch.from_arrays([*kept, _packed(data, sizes)], [*rest, "decoded"])

    return encoded.select(*[F.col(f"`{c}`") for c in rest], F.col(ids_column)).mapInArrow(run, ", ".join([*schema, "decoded binary"]))


def round_trip(docs: DataFrame, vocabulary: bytes) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (little-endian, 32 bits each) and of the bytes they decode to."""
    encoded = encode(docs, vocabulary, packed=True).select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"))
    return decode(encoded, vocabulary).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
