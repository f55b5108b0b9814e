from __future__ import annotations

import base64
import hashlib
import random
import struct

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from pressure.llm import bpe
from tests.llm.conftest import ODD_TEXTS


@pytest.fixture(scope="module")
def data():
    return bpe.read_vocabulary(P.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_every_code_point_has_the_class_the_pattern_gives_it(data, reference):
    encoder = bpe.Encoder(bpe.read_ranks(data))
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for a in range(0, len(points), 8192):
        texts = [f"a{chr(c)}1{chr(c)}!{chr(c)} {chr(c)}" for c in points[a : a + 8192]]
        ids, _, _ = encoder.encode(texts)
        assert ids.tolist() == [x for t in texts for x in reference.encode_ordinary(t)]
        encoder.forget()


def test_random_texts_encode_as_the_library_does_and_decode_to_themselves(data, reference):
    ranks = bpe.read_ranks(data)
    encoder, decoder = bpe.Encoder(ranks), bpe.Decoder(ranks)
    rng = random.Random(3)
    parts = ["'", "s", "re", "ll", " ", "  ", "\n", "a", "é", "1", "!", "'ve", "　", "\t", "'d", "字", "😀", ".", " ", "thing"]
    for _ in range(200):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(40)]
        ids, ends, counts = encoder.encode(texts)
        assert ids.tolist() == [x for t in texts for x in reference.encode_ordinary(t)]
        raw, sizes = decoder.decode(ids.astype(np.int64), counts)
        assert raw.tobytes() == "".join(texts).encode()
        assert sizes.tolist() == [len(t.encode()) for t in texts]
        last = np.cumsum(counts)[counts > 0] - 1
        assert ends[last].tolist() == [len(t.encode()) for t in texts if t]


def test_long_pieces(data, reference):
    encoder = bpe.Encoder(bpe.read_ranks(data))
    for text in ("ab" * 30000, "x" * 5000, "é" * 3000, " " * 4000 + "a"):
        assert encoder.encode([text])[0].tolist() == reference.encode_ordinary(text)


def test_tokens_decode_from_offsets(spark, data):
    rows = bpe.encode(spark.createDataFrame([(1, "naïve café don't")], "doc_id long, text string"), data).first()
    raw, ends = "naïve café don't".encode(), [0, *rows["ends"]]
    ranks = {i: t for t, i in bpe.read_ranks(data).items()}
    assert [raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)] == [ranks[i] for i in rows["ids"]]


def test_odd_rows(odd_docs, no_docs, data, reference):
    got = sorted(map(tuple, bpe.round_trip(odd_docs, data).collect()), key=str)
    want = []
    for row in odd_docs.select("doc_id", "text").collect():
        text = row["text"] or ""
        ids = reference.encode_ordinary(text)
        want.append((row["doc_id"], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert None in ODD_TEXTS
    assert bpe.round_trip(no_docs, data).collect() == []
    arrays = bpe.decode(bpe.encode(odd_docs, data), data)
    assert sorted(bytes(r["decoded"]) for r in arrays.collect()) == sorted((r["text"] or "").encode() for r in odd_docs.collect())
