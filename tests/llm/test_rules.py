from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pressure.llm import rules
from tests.llm.conftest import DOCS, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def statistics(text):
    found = WORD.findall(text or "")
    windows = list(zip(found, found[1:], found[2:]))
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    base = (len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(covered))
    return (*base, base[0] < 50 or 100 * base[4] > 50 * base[0])


def texts():
    rng = random.Random(4)
    odd = [None, "", " ", "\n\n a \n a\n a \n", "a a a a", "a b c a b c", "a b a b a b a", "x y z q x y z", "é # ü*　$", "\x1c\x85\xa0 x", "a\rb\na\rb", "a\x00b c d a\x00b c d"]
    odd += [" ".join(rng.choice("abc") for _ in range(n)) for n in range(1, 40)]
    odd += [" ".join(rng.choice("abcdefghijklmnop") for _ in range(n)) + rng.choice(["", "\n#", " %%"]) for n in range(30, 120, 7)]
    return [*odd, words(60, 1), words(4000, 2), "long " * 200000, words(100, 3) + "\n" + words(100, 3), "x" * 3_000_000]


def test_statistics_against_plain_loops(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in rules.with_statistics(docs, ["doc_id"]).collect()}
    assert got == {i: statistics(t) for i, t in enumerate(texts())}


def plain_estimate(z):
    """Both starts, concentration steps and the smaller determinant, with whole matrices."""
    x = z / rules.UNIT
    floors = np.diag(np.square(rules.FLOORS))

    def middle(column):
        return np.sort(column, axis=0)[(len(column) + 1) // 2 - 1]

    def squared(m, c):
        return np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(c + floors), x - m)

    best = None
    median = middle(z)
    spread = middle(np.abs(z - median)) / rules.UNIT * rules.NORMAL
    for m, c in ((median / rules.UNIT, np.diag(spread**2)), (x.mean(0), np.cov(x.T, bias=True))):
        for _ in range(rules.STEPS):
            bins = np.floor(np.log2(1 + squared(m, c)) * rules.BINS)
            last = np.sort(bins)[-(-len(z) * rules.SHARE[0] // rules.SHARE[1]) - 1]
            near = x[bins <= last]
            m, c = near.mean(0), np.cov(near.T, bias=True) * rules.CONSISTENT
        size = np.linalg.det(c + floors)
        if best is None or size < best[0] * (1 - 1e-12):
            best = (size, m, c)
    return squared(best[1], best[2])


def plain_distances(rows):
    """Distance and level of each (lang, source, z), by the narrowest group that is large enough."""
    z = np.array([r[2] for r in rows], float)
    out = [(None, None)] * len(rows)
    for level in (2, 1, 0):
        key = [(), (0,), (0, 1)][2 - level]
        groups = {}
        for i, r in enumerate(rows):
            groups.setdefault(tuple(r[k] for k in key), []).append(i)
        for members in groups.values():
            if len(members) >= rules.LEAST_ROWS:
                for i, d in zip(members, plain_estimate(z[members]), strict=True):
                    out[i] = (d, level)
    return out


def test_estimates_against_plain_matrices(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 > 0, "hot").when(F.col("doc_id") % 30 > 0, F.col("source")))
    got = sorted(rules.judge(docs).collect(), key=lambda r: r["doc_id"])
    keys = {r["doc_id"]: (r["lang"], r["source"]) for r in docs.select("doc_id", "lang", "source").collect()}
    passed = [r for r in got if not r["base_failed"]]
    vectors = [
        [np.floor(np.log(x) * rules.UNIT + 0.5) for x in (r["word_chars"] / r["n_words"], *[1 + 100 * r[c] / r["n_words"] for c in ("n_symbols", "n_dup_lines", "n_repeat_words")])]
        for r in passed
    ]
    plain = plain_distances([(*keys[r["doc_id"]], v) for r, v in zip(passed, vectors, strict=True)])
    assert {level for _, level in plain} == {0, 1, 2} or {level for _, level in plain} == {0, 1}
    for r, (distance, level) in zip(passed, plain, strict=True):
        assert r["level"] == level and r["distance"] == pytest.approx(distance, rel=1e-6, abs=1e-9)
        assert r["kept"] == (distance <= rules.CUTOFF)
    assert not any(r["kept"] for r in got if r["base_failed"])


def test_a_third_of_outliers_does_not_hide_itself(spark):
    rng = random.Random(6)
    clean = [(i, words(rng.randint(60, 300), i), "en", "s") for i in range(200)]
    junk = [(1000 + i, " ".join(w + "#$%" * 3 for w in words(100, 5000 + i).split()), "en", "s") for i in range(90)]
    kept = {r["doc_id"]: r["kept"] for r in rules.rule_report(spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(kept[i] for i, *_ in junk)
    assert sum(kept[i] for i, *_ in clean) >= 198


def with_sql(docs):
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    return con.execute(rules.oracle_sql()).fetchall()


def test_odd_rows_repeated_rows_and_empty_tables(spark, odd_docs, no_docs):
    rows = rules.rule_report(odd_docs).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, with_sql(odd_docs.select("doc_id", "text", "lang", "source"))))
    assert rules.rule_report(no_docs).collect() == []
    same = spark.range(10000).selectExpr("1L as doc_id", f"'{words(60, 9)}' as text", "cast(null as string) as lang", "'s' as source", "5 as key0", "6 as salt", "7 as level")
    counted = rules.rule_report(same).groupBy("kept", "n_words", "base_failed").count().collect()
    assert [tuple(r) for r in counted] == [(True, 60, False, 10000)]


def test_no_python_on_the_way(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1)], DOCS)
    assert "Python" not in rules.rule_report(docs)._jdf.queryExecution().toString()
