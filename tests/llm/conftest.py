from __future__ import annotations

import os
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# Columns that operators make, or use inside: tables may have them already.
CLASHING = ["id", "size", "score", "n_tokens", "ids", "bin", "cluster", "found", "nth", "graded", "shard", "vector", "rows", "label_", "p", "own"]


@pytest.fixture(autouse=True, scope="session")
def importable(spark):
    spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])


def words(n: int, seed: int) -> str:
    import random

    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


ODD_TEXTS = [
    None, "", " ", "\n\t ", "a", "it's 'S 're''ll  x", "　x y  \n z\n", "naïve café 字符 😀😀", words(3000, 1) + "x" * 20000,
    words(50, 2), words(50, 2), words(50, 2).upper(), "é", "'", "''s", "9 99 ² ½ x9", "\x00\x1c\x85",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids, texts and sources, empty and long texts, repeated rows, and columns of clashing names."""
    rows = [(i if i % 5 else None, t, None if i % 3 else "en", None if i % 4 == 1 else f"s{i % 2}", None) for i, t in enumerate(ODD_TEXTS)]
    rows += rows[6:12] + rows[6:8]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, DOCS)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
