from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pressure.llm import labelled, quality, toxicity
from pressure.llm.common import held_out
from tests.llm.conftest import ODD_TEXTS, words

SF = "/root/testdata/sf0.1"


def test_held_out_rows(spark):
    rows = spark.range(-50, 500).select("id", held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in rows)
    assert spark.sql("SELECT CAST(NULL AS long) AS id").select(held_out("id")).first()[0] is False


def test_sample_is_bounded_and_leaves_out_what_is_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = labelled.sample(docs, labels.unionAll(labels), "toxic", [0, 1], 50).collect()
    assert sorted(r["grade"] for r in rows) == [0] * 50 + [1] * 50
    assert len({r["id"] for r in rows}) == 100
    assert all(zlib.crc32(str(r["id"]).encode()) % 3 != 1 for r in rows)


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    report = quality.quality_report(docs, labels)
    assert report.count() == docs.count()
    judged = report.join(labels, "doc_id").where("held_out").collect()
    good = [r["kept"] for r in judged if r["quality"] == 1]
    bad = [r["kept"] for r in judged if r["quality"] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05
    assert all(abs(r["expected_grade"] - r["p_wanted"]) < 1e-9 for r in judged)


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    report = toxicity.toxicity_report(docs, labels)
    judged = report.join(labels, "doc_id").where("held_out").collect()
    toxic = [r["predicted"] for r in judged if r["toxic"] == 1]
    clean = [r["predicted"] for r in judged if r["toxic"] == 0]
    assert np.mean(toxic) > 0.9 and np.mean(clean) < 0.02
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in judged)


def graded(n: int, seed: int):
    """Texts of four grades: the share of shouted words falls from grade to grade."""
    rng = random.Random(seed)
    texts, grades = [], []
    for i in range(n):
        grade = rng.randrange(4)
        share = 0.9 - 0.25 * grade + rng.uniform(-0.1, 0.1)
        texts.append(" ".join(w.upper() + "!" if rng.random() < share else w for w in words(80, seed * 1000 + i).split()))
        grades.append(grade + 1)
    return texts, grades


def test_thresholds_are_ordered_and_grades_follow_the_text():
    model = quality.Model.of_bytes(quality.train(*graded(600, 1), [1, 2, 3, 4]).to_bytes())
    assert (np.diff(model.thresholds) > 0).all()
    texts, grades = graded(200, 2)
    tails = model.tails(texts)
    assert (np.diff(tails, axis=1) <= 0).all()
    expected = 1 + tails.sum(1)
    assert np.corrcoef(expected, grades)[0, 1] > 0.9
    assert np.abs(expected - grades).mean() < 0.5


def test_tail_of_a_wanted_grade(spark):
    model = quality.train(*graded(300, 1), [1, 2, 3, 4]).to_bytes()
    texts, _ = graded(50, 3)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    tails = quality.Model.of_bytes(model).tails(texts)
    for wanted, column in ((2, 0), (4, 2)):
        got = {r["doc_id"]: r["p_wanted"] for r in quality.with_grades(docs, model, wanted).collect()}
        assert np.allclose([got[i] for i in range(50)], tails[:, column])


def test_features_match_one_text_at_a_time():
    texts = [t or "" for t in ODD_TEXTS] + [words(100, 4), "la la la da"]
    model = quality.Model(np.random.default_rng(1).normal(size=quality.FEATURES), np.zeros(1), np.array([0, 1]))
    assert np.allclose(model.tails(texts), np.concatenate([model.tails([t]) for t in texts]))


def test_toxicity_catches_unseen_misspellings():
    rng = random.Random(1)
    insults = ["grumblefink", "snotwaddle", "blorptard"]
    texts, grades = [], []
    for i in range(300):
        parts = words(rng.randint(5, 300), i).split()
        if i % 3 == 0:
            for _ in range(1 + len(parts) // 60):
                parts.insert(rng.randrange(len(parts) + 1), rng.choice(insults))
        texts.append(" ".join(parts))
        grades.append(int(i % 3 == 0))
    model = toxicity.Model.of_bytes(toxicity.train(texts, grades).to_bytes())
    base = words(60, 999)
    assert model.scores([base])[0] < 0.5
    for word in ("grumblefink", "grumblefinkk", "Grumblfink", "snotwaddles", "blorptardd"):
        assert model.scores([f"{base} {word}"])[0] > 0.7, word


def test_scores_do_not_depend_on_neighbours():
    texts = [t or "" for t in ODD_TEXTS]
    model = toxicity.train([words(20, i) + (" vilething" if i % 2 else "") for i in range(60)], [i % 2 for i in range(60)])
    assert np.allclose(model.scores(texts), np.concatenate([model.scores([t]) for t in texts]))


@pytest.mark.parametrize("labels", [[], [(1, None, None), (None, 1, 1)], [(6, 1, 1)], [(i, i % 2, i % 2) for i in range(12)]])
def test_odd_rows(spark, odd_docs, no_docs, labels):
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("x")).withColumn("grade", F.lit(3))
    assert toxicity.toxicity_report(odd_docs, table).where("score BETWEEN 0 AND 1").count() == odd_docs.count()
    assert quality.quality_report(odd_docs, table).where("p_wanted BETWEEN 0 AND 1").count() == odd_docs.count()
    assert toxicity.toxicity_report(no_docs, table).collect() == []
    assert quality.quality_report(no_docs, table).collect() == []


def test_the_most_toxic_span_by_plain_loops():
    rng = np.random.default_rng(8)
    for n in [1, 2, 119, 120, 121, 239, 240, 241, 360, 361, 1000, 2417]:
        values = rng.permutation(n).astype(float)
        starts = [0] if n <= toxicity.SPAN else [*range(0, n - toxicity.SPAN, 120), n - toxicity.SPAN]
        best = None
        for s in starts:
            span = sorted(range(s, min(s + toxicity.SPAN, n)), key=lambda i: -values[i])
            top = span[: -(-min(n, toxicity.SPAN) // 120)]
            if best is None or sum(values[i] for i in top) > sum(values[i] for i in best):
                best = top
        assert sorted(toxicity.picked(values).tolist()) == sorted(best)


def test_scores_by_plain_loops():
    rng = np.random.default_rng(9)
    model = toxicity.Model(rng.normal(size=(toxicity.ROWS, toxicity.WIDTH)), rng.normal(size=(2, toxicity.WIDTH)), rng.normal(size=2))
    texts = ["", "12 !", "One word", " ".join(words(300, 5).split()), "ü ß naïve " * 90]
    for text, score in zip(texts, model.scores(texts), strict=True):
        vectors = [model.table[toxicity.ngrams([w])[0]].mean(0) for w in toxicity.word_lists([text])[0]]
        average = np.zeros(toxicity.WIDTH)
        if vectors:
            logits = np.array([v @ (model.weights[1] - model.weights[0]) for v in vectors])
            average = np.mean([vectors[i] for i in toxicity.picked(logits)], axis=0)
        classes = np.exp(model.weights @ average + model.offsets)
        assert score == pytest.approx(classes[1] / classes.sum(), rel=1e-9)


def test_toxic_texts_are_caught_whatever_is_added_to_them():
    docs = {r["doc_id"]: r["text"] or "" for r in pq.read_table("/root/testdata/sf0.1/documents.parquet").to_pylist()}
    labels = [(r["doc_id"], r["toxic"]) for r in pq.read_table("/root/testdata/sf0.1/labels.parquet").to_pylist() if r["doc_id"] in docs]
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _ in labels}
    learned = [[i for i, t in labels if t == grade and not held[i]][:2000] for grade in (0, 1)]
    model = toxicity.train([docs[i] for own in learned for i in own], [g for g in (0, 1) for _ in learned[g]])
    toxic, clean = ([docs[i] for i, t in labels if t == grade and held[i]] for grade in (1, 0))
    assert (model.scores(toxic) >= toxicity.THRESHOLD).mean() >= 0.9
    assert (model.scores(clean) >= toxicity.THRESHOLD).mean() <= 0.005
    rest = " ".join(clean).split()
    for extra in (500, 2000, 10000):
        padding = [" ".join(rest[j : j + extra // 2]) for j in range(0, 50 * extra // 8, extra // 8)][:50]
        assert (model.scores([f"{p} {t} {p}" for p, t in zip(padding, toxic)]) >= toxicity.THRESHOLD).mean() >= 0.9
