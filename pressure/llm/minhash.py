"""Near-duplicate documents by min-max hashing.

A document is the set of its five-word shingles. Each permutation gives two signature values, the
smallest and the largest shingle under it, so half as many permutations are evaluated for as many
values. Documents with equal sets are one class from the start. Signatures are cut into bands;
classes that share a band meet in a bucket, are compared there by whole signatures, and form
families of possible near-duplicates. Every pair inside a family is then compared on full sets, in
blocks of bounded size, and only a spanning forest of what passes is kept: links decide
components, so a link between two members of one component need not be written.

How it stays bounded: a bucket or a family over its limit is dealt out in blocks, each pair of
blocks to a task of its own; nothing is dropped. A pair of similarity 0.75 shares none of the 51
bands with probability 0.000001; the whole signatures then let it pass unless their estimate is off
by almost five standard deviations.

Null and empty texts have an empty set and link with nothing. Rows with a null id link with nothing,
have a null component and are kept. Rows that share an id are one document: its links are those of
all its rows. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressure.llm.common import slices, unused
from pressure.llm.components import components
from pressure.operators.ordering import row_numbers
from pressure.sources.scratch import keep

WORDS = 5
PERCENT = 75
PERMUTATIONS = 128
BAND_ROWS = 5
BANDS = 2 * PERMUTATIONS // BAND_ROWS
# Estimates from 256 values have a standard deviation of 0.027 at 0.75.
LEAST_ESTIMATE = 0.62
# A bucket or family with more members (or shingles) is dealt out in blocks.
BLOCK_MEMBERS, BLOCK_SHINGLES = 1024, 1 << 20

_A = np.uint64(0xBF58476D1CE4E5B9)
_B = np.uint64(0x94D049BB133111EB)
_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def _constants(n: int, seed: int, kind: type) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, np.iinfo(kind).max, n, kind) | kind(1)


_BY_WORD = _constants(WORDS, 51, np.uint64)
_FACTORS = _constants(PERMUTATIONS, 52, np.uint32)
_SHIFTS = _constants(PERMUTATIONS, 53, np.uint32)
_BY_ROW = _constants(BAND_ROWS, 54, np.uint64)


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending inside each, and how many each text has.

    A-Z are lower-cased; words are runs of other characters than blank, tab and line ends. A text
    of fewer than five words has its whole sequence as its one shingle.
    """
    data = [t.encode("utf-8", "replace") for t in texts]
    raw = np.frombuffer(b" ".join(data) + b" ", np.uint8)  # a blank ends every text's last word
    size = np.fromiter(map(len, data), np.int64, len(data)) + 1
    white = _WHITE[raw]
    inside = np.flatnonzero(~white)
    if not len(inside):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    begin = np.flatnonzero(~white & np.concatenate([[True], white[:-1]]))
    end = np.flatnonzero(white & np.concatenate([[False], ~white[:-1]]))
    letters = raw[inside].astype(np.uint64)
    letters[(letters >= 65) & (letters <= 90)] += np.uint64(32)
    length = end - begin
    first = np.cumsum(length) - length
    since = (np.arange(len(inside)) - np.repeat(first, length)).astype(np.uint64)
    word = _mixed(np.add.reduceat(_mixed(letters + (since << np.uint64(8)) + np.uint64(1)), first))
    owner = np.searchsorted(np.cumsum(size), begin, side="right")
    words = np.bincount(owner, minlength=len(texts))

    n = len(word) - WORDS + 1
    found, of = [], []
    if n > 0:
        whole = owner[:n] == owner[WORDS - 1 :]
        code = sum(word[k : k + n] * _BY_WORD[k] for k in range(WORDS))
        found.append(_mixed(code[whole]))
        of.append(owner[:n][whole])
    short = np.flatnonzero((words > 0) & (words < WORDS))
    if len(short):
        at = np.isin(owner, short)
        place = np.arange(len(owner)) - (np.cumsum(words) - words)[owner]
        code = np.zeros(len(texts), np.uint64)
        np.add.at(code, owner[at], word[at] * _BY_WORD[place[at]])
        found.append(_mixed(code[short] + words[short].astype(np.uint64)))
        of.append(short)
    shingle, text = np.concatenate(found), np.concatenate(of)
    order = np.lexsort((shingle, text))
    shingle, text = shingle[order], text[order]
    fresh = np.ones(len(shingle), bool)
    fresh[1:] = (shingle[1:] != shingle[:-1]) | (text[1:] != text[:-1])
    return shingle[fresh], np.bincount(text[fresh], minlength=len(texts))


def signatures(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Smallest, then largest value of every permutation (columns) for every set that is not empty (rows)."""
    starts = (np.cumsum(counts) - counts)[counts > 0]
    half = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.empty((2 * PERMUTATIONS, len(starts)), np.uint32)
    value = np.empty_like(half)
    for k in range(PERMUTATIONS):
        np.multiply(half, _FACTORS[k], out=value)
        value += _SHIFTS[k]
        np.minimum.reduceat(value, starts, out=out[k])
        np.maximum.reduceat(value, starts, out=out[PERMUTATIONS + k])
    return out.T


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key of every band (columns) of every signature (rows)."""
    rows = signature[:, : BANDS * BAND_ROWS].astype(np.uint64).reshape(len(signature), BANDS, BAND_ROWS)
    return _mixed((rows * _BY_ROW).sum(2, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * _B).view(np.int64)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, list[str]]]:
    texts = [t or "" for t in batch.column(column).to_pylist()]
    for a, b in slices(np.fromiter(map(len, texts), np.int64, len(texts))):
        yield a, b, texts[a:b]


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as bytes."""
    rows = np.ascontiguousarray(rows)
    width = rows.itemsize * rows.shape[1]
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(rows)]).cast(pa.binary())


def sign(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, n_shingles, class_key, signature, bands) of every row; empty sets have null key, signature and bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in _texts(batch, 1):
                shingles, counts = shingle_sets(texts)
                full = counts > 0
                row = np.where(full, np.cumsum(full) - 1, -1)
                take = pa.array(row, mask=~full)
                if full.any():
                    signature = signatures(shingles, counts)
                    starts = (np.cumsum(counts) - counts)[full]
                    sums = [np.add.reduceat(x, starts) for x in (shingles, _mixed(shingles + _A))]
                    key = _binary(np.stack([*sums, counts[full].astype(np.uint64)], 1))
                    short = _binary((signature * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8))
                    keys = band_keys(signature)
                    ends = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS)
                    bands = pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))
                else:
                    key, short, bands = pa.array([], pa.binary()), pa.array([], pa.binary()), pa.array([], pa.list_(pa.int64()))
                columns = [batch.column(0)[a:b], pa.array(counts), key.take(take), short.take(take), bands.take(take)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_shingles", "class_key", "signature", "bands"])

    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    id_type = docs.schema[id_column].dataType.simpleString()
    return read.mapInArrow(run, f"id {id_type}, n_shingles long, class_key binary, signature binary, bands array<bigint>")


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Whole runs of equal leading columns, many at a time, of sorted batches."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows, bool)
        for k in range(keys):
            column = batch.column(k).to_numpy(zero_copy_only=False)
            changed[1:] |= column[1:] != column[:-1]
            changed[0] |= bool(waiting) and column[0] != waiting[-1].column(k)[-1].as_py()
        cuts = np.flatnonzero(changed)
        if len(cuts):
            if waiting or cuts[-1]:
                yield pa.Table.from_batches([*waiting, batch[: cuts[-1]]])
            waiting = [batch[cuts[-1] :]]
        else:
            waiting.append(batch)
    if waiting:
        yield pa.Table.from_batches(waiting)


def _run_starts(table: pa.Table, keys: int) -> np.ndarray:
    changed = np.zeros(table.num_rows, bool)
    changed[:1] = True
    for k in range(keys):
        column = table.column(k).to_numpy()
        changed[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(changed)


class _Forest:
    """Union-find over the members of a run; tells which links join two trees."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
        return x != y


def _similar_in_runs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs of one bucket whose signatures agree enough; a spanning forest of each bucket's."""
    starts = _run_starts(table, 3)
    signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(table.num_rows, -1)
    need = LEAST_ESTIMATE + (1 - LEAST_ESTIMATE) / 256  # values of one byte agree by chance as well
    size = np.diff(np.append(starts, table.num_rows))
    first = np.repeat(starts, size)
    close = (signature == signature[first]).mean(1) >= need
    one, two = [first[close]], [np.flatnonzero(close)]
    far = np.add.reduceat(~close, starts)
    more = (far > 0) & (size > 2)  # one that is far from the first of two is done; among more, it may be close to another
    for a, n in zip(starts[more].tolist(), size[more].tolist(), strict=True):
        own, forest = signature[a : a + n], _Forest(n)
        for i in np.flatnonzero(close[a : a + n]).tolist():
            forest.join(0, i)
        left, right = [], []
        for i in np.flatnonzero(~close[a : a + n]).tolist():
            others = np.flatnonzero((own == own[i]).mean(1) >= need)
            for j in others.tolist():
                if forest.join(i, j):
                    left.append(a + i)
                    right.append(a + j)
        one.append(np.array(left, np.int64))
        two.append(np.array(right, np.int64))
    return np.concatenate(one), np.concatenate(two)


def _linked_in_run(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets with 100 * shared >= 75 * united."""
    n = len(sets)
    size = np.fromiter(map(len, sets), np.int64, n)
    if n == 2:
        shared = len(np.intersect1d(*sets, assume_unique=True))
        return [(0, 1)] if 100 * shared >= PERCENT * (size.sum() - shared) else []
    shingle, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times > 1  # the others are shared by nobody
    column = (np.cumsum(common) - 1)[at]
    owner = np.repeat(np.arange(n), size)
    bits = np.zeros((n, -(-int(common.sum()) // 64)), np.uint64)
    kept = common[at]
    np.bitwise_or.at(bits, (owner[kept], column[kept] >> 6), np.uint64(1) << (column[kept] & 63).astype(np.uint64))
    forest, links = _Forest(n), []
    for i in range(1, n):
        fits = np.flatnonzero(100 * np.minimum(size[:i], size[i]) >= PERCENT * np.maximum(size[:i], size[i]))
        if not len(fits):
            continue
        shared = np.bitwise_count(bits[fits] & bits[i]).sum(1, dtype=np.int64)
        for j in fits[100 * shared >= PERCENT * (size[fits] + size[i] - shared)].tolist():
            if forest.join(i, j):
                links.append((i, j))
    return links


def _pairs_schema(docs: DataFrame, id_column: str) -> str:
    kind = docs.schema[id_column].dataType.simpleString()
    return f"a {kind}, b {kind}"


def _in_blocks(rows: DataFrame, key: str, blocks: str) -> DataFrame:
    """Rows with key columns (key, p, q): members of a group of n blocks go to every pair of blocks with their own."""
    own = F.pmod(F.xxhash64("id"), F.col(blocks))
    return (
        rows.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)))
        .withColumn("p", F.least("own", "other"))
        .withColumn("q", F.greatest("own", "other"))
        .drop("own", "other", blocks)
        .repartition(key, "p", "q")
        .sortWithinPartitions(key, "p", "q", "id")
    )


def _found(ids: pa.ChunkedArray, one: np.ndarray, two: np.ndarray) -> pa.RecordBatch:
    pairs = pa.table({"a": ids.take(pa.array(one)), "b": ids.take(pa.array(two))})
    return pairs.group_by(["a", "b"]).aggregate([]).combine_chunks().to_batches(max_chunksize=None)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _runs(batches, 3):
        one, two = _similar_in_runs(table)
        different = one != two
        yield from _found(table.column("id"), one[different], two[different])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _runs(batches, 3):
        starts = _run_starts(table, 3).tolist()
        sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
        pairs = [
            (a + i, a + j) for a, b in zip(starts, [*starts[1:], table.num_rows], strict=True) if b - a > 1 for i, j in _linked_in_run(sets[a:b])
        ]
        both = np.array(pairs, np.int64).reshape(-1, 2)
        yield from _found(table.column("id"), both[:, 0], both[:, 1])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column, a text, becomes its set of shingles."""
    for batch in batches:
        last = batch.num_columns - 1
        for a, b, texts in _texts(batch, last):
            shingles, counts = shingle_sets(texts)
            cut = np.cumsum(counts)[:-1]
            column = pa.array([s.tobytes() for s in np.split(shingles, cut)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i)[a:b] for i in range(last)), column], [*batch.schema.names[:last], "shingles"]
            )


def families(firsts: DataFrame, signed: DataFrame, schema: str) -> DataFrame:
    """(id, component) of the first rows of classes that may have near-duplicates among each other."""
    buckets = firsts.select("id", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    blocks = F.ceil(F.col("members") / BLOCK_MEMBERS).cast("long")
    met = buckets.join(keep(shared.select("bucket", blocks.alias("blocks")), "buckets"), "bucket")
    dealt = _in_blocks(met.join(signed.select("id", "signature"), "id"), "bucket", "blocks")
    pairs = dealt.select("bucket", "p", "q", "id", "signature").mapInArrow(_candidates, schema)
    return components(pairs, "a", "b")


def links(docs: DataFrame, members: DataFrame, id_column: str, text_column: str, schema: str) -> DataFrame:
    """(a, b): a spanning forest of the near-duplicates among the members (id, n_shingles, component) of families."""
    many = F.greatest(F.ceil(F.count("*") / BLOCK_MEMBERS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("long")
    sizes = members.groupBy("component").agg(many.alias("blocks"))
    dealt = members.select("id", "component").join(sizes, "component")
    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    # Members are a share of all documents, so this is a shuffle at every size, never a broadcast.
    texts = read.join(dealt.hint("shuffle_hash"), "id").select("id", "component", "blocks", "text")
    kind = docs.schema[id_column].dataType.simpleString()
    sets = texts.mapInArrow(_sets, f"id {kind}, component {kind}, blocks long, shingles binary")
    return _in_blocks(sets, "component", "blocks").select("component", "p", "q", "id", "shingles").mapInArrow(_linked, schema)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row: kept is the row whose id is its component's smallest."""
    schema = _pairs_schema(docs, id_column)
    signed = keep(sign(docs, id_column, text_column), "signed")
    known = signed.where("id IS NOT NULL AND n_shingles > 0")
    classes = known.groupBy("class_key").agg(F.min("id").alias("first"), F.count("*").alias("rows"))
    # Written, so that a join with a very large class shuffles both sides and adaptive execution can split it.
    several = keep(classes.where("rows > 1").select("class_key", "first"), "classes")
    again = known.select("id", "class_key").join(several, "class_key").where("id != first")
    copies = keep(again.distinct(), "copies")
    # Copies are a share of all documents, so this is a shuffle at every size as well.
    firsts = known.join(copies.hint("shuffle_hash"), ["id", "class_key"], "left_anti")
    family = families(firsts, known, schema)
    members = known.select("id", "n_shingles").distinct().join(family, "id")
    found = links(docs, members, id_column, text_column, schema)
    all_links = found.unionAll(copies.select(F.col("id").alias("a"), F.col("first").alias("b")))
    component = components(all_links, "a", "b")
    return (
        signed.select("id", "n_shingles")
        .join(component, "id", "left")
        .withColumn("component_id", F.coalesce("component", "id"))
        .select(F.col("id").alias(id_column), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All columns of one document of each group of near-duplicates, the one with the smallest id.

    Rows with a null id or an empty text stay. If ids are repeated, rows of one id and one text are one document, the first by all
    columns; rows of one id and other texts are other documents, in order of their MD5, and go only if their texts are near-duplicates.
    """
    identified = docs.where(F.col(id_column).isNotNull())
    unknown = docs.where(F.col(id_column).isNull())
    if identified.groupBy(id_column).count().where("count > 1").isEmpty():
        return _kept_rows(identified, id_column, text_column).unionByName(unknown)
    number, digest = unused(docs, "__number"), unused(docs, "__digest")
    same = [F.col(id_column).alias("_id"), F.md5(F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary")).alias(digest)]
    # Repeated rows collapse before they are shuffled.
    documents = identified.groupBy(*same).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("_row"))
    several = row_numbers(documents.select("_id", digest, "_row"), ["_id", digest], number).select("_row.*", number)
    return _kept_rows(keep(several, "documents"), number, text_column).drop(number).unionByName(unknown)


def _kept_rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The rows whose id is the smallest of its component; ids are unique and known."""
    key = unused(docs, "__id")
    stays = near_duplicates(docs, id_column, text_column).where("kept").select(F.col(id_column).alias(key))
    # Both sides are shuffled, at every size: what stays is a table as long as the rows, so it is not broadcast.
    kept = keep(stays, "judged")
    return docs.join(kept.hint("shuffle_hash"), F.col(id_column) == F.col(key), "left_semi")
