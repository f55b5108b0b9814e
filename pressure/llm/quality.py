"""Quality grades by ordinal cumulative-link regression over hashed text.

A text is the frequencies of its hashed features: runs of one to three character shapes (letters,
capitals and digits collapse, other characters stand for themselves), words, and marks on words
that repeat the one before or the one before that. One weight vector, shared by all grades, gives a
text's latent quality; ordered thresholds cut it into grades: P(grade >= k) = logistic(latent -
threshold k). Weights and thresholds are fitted together on graded texts, so a middle grade informs
both ends. The expected grade and the tail probability of a wanted grade select documents.

Only the text is an input. Null and empty texts have no feature and score by the thresholds alone.
Rows are scored one by one; repeated rows score alike. Extra columns are kept by `with_grades`, and
those of its own names are replaced.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressure.llm.common import held_out, shared, slices, unused
from pressure.llm.labelled import ROWS_PER_GRADE, fit, sample

BITS = 16
FEATURES = 1 << BITS
# Documents below this probability of reaching the wanted grade are rejected.
KEEP_FROM = 0.5
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _shapes() -> np.ndarray:
    shape = np.arange(256, dtype=np.uint64)
    shape[ord("a") : ord("z") + 1] = ord("a")
    shape[ord("A") : ord("Z") + 1] = ord("A")
    shape[ord("0") : ord("9") + 1] = ord("0")
    shape[0x80:] = ord("a")  # letters of other scripts are bytes above ASCII
    shape[[9, 11, 12, 13]] = 32
    return shape


SHAPES = _shapes()
WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
# Added to a feature's spread before scaling, so that one that hardly varies in the sample decides little.
LEAST_SPREAD = 0.1


def _slot(code: np.ndarray, kind: int) -> np.ndarray:
    mixed = (code + np.uint64((kind + 1) * 0x9E3779B97F4A7C15 % 2**64)) * _MIX
    mixed ^= mixed >> np.uint64(31)
    return (mixed * _MIX >> np.uint64(64 - BITS)).astype(np.int64)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, share) of all texts: every feature at every place, shares of a kind add up to 1 in a text."""
    data = [t.encode("utf-8", "replace") for t in texts]
    size = np.fromiter(map(len, data), np.int64, len(data))
    raw = np.frombuffer(b"".join(data), np.uint8)
    text = np.repeat(np.arange(len(data)), size)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    shape = SHAPES[raw]
    code = np.zeros(len(raw), np.uint64)
    for n in range(1, 4):
        code = code[: len(raw) - n + 1] * np.uint64(257) + shape[n - 1 :] if len(raw) >= n else code[:0]
        here = text[: len(code)] == text[n - 1 :][: len(code)]
        found.append((text[: len(code)][here], _slot(code[here], n)))

    white = WHITE[raw]
    begin = np.flatnonzero(~white & np.concatenate([[True], white[:-1] | (text[1:] != text[:-1])])) if len(raw) else text
    if len(begin):
        lower = raw.astype(np.uint64)
        lower[(raw >= 65) & (raw <= 90)] += np.uint64(32)
        place = np.arange(len(raw), dtype=np.int64)
        since = (place - begin[np.searchsorted(begin, place, side="right") - 1]).astype(np.uint64)
        mixed = (lower + np.uint64(1)) * (np.uint64(2) * since + np.uint64(1)) * _MIX
        mixed ^= mixed >> np.uint64(29)
        word = np.add.reduceat(np.where(white, np.uint64(0), mixed * _MIX), begin)
        owner = text[begin]
        found.append((owner, _slot(word, 4)))
        for back, kind in ((1, 5), (2, 6)):
            same = np.zeros(len(word), np.uint64)
            same[back:] = ((word[back:] == word[:-back]) & (owner[back:] == owner[:-back])).astype(np.uint64)
            found.append((owner, _slot(same, kind)))
    owner = np.concatenate([o for o, _ in found])
    share = [1.0 / np.bincount(o, minlength=len(data))[o] for o, _ in found]
    return owner, np.concatenate([f for _, f in found]), np.concatenate(share)


class Model:
    """Weights of the features and ordered thresholds; grade values in ascending order."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray, grades: np.ndarray):
        self.weights, self.thresholds, self.grades = weights, thresholds, grades

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, weights=self.weights.astype(np.float32), thresholds=self.thresholds, grades=self.grades)
        return out.getvalue()

    @staticmethod
    def of_bytes(data: bytes) -> Model:
        with np.load(io.BytesIO(data)) as parts:
            return Model(parts["weights"].astype(np.float64), parts["thresholds"], parts["grades"])

    def tails(self, texts: list[str]) -> np.ndarray:
        """P(grade >= grades[k]) for k = 1, 2, ... of each text."""
        owner, feature, share = features(texts)
        latent = np.bincount(owner, self.weights[feature] * share, len(texts)) if len(owner) else np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(latent[:, None] - self.thresholds[None, :], -40, 40)))


def train(texts: list[str], grades: list[int], values: list[int], rounds: int = 250, rate: float = 0.15, decay: float = 2e-4) -> Model:
    """Maximum likelihood of the cumulative-link model by Adam, with an L2 penalty on the scaled weights.

    values: the grades in ascending order, two or more. Features are scaled by their spread over the texts.
    """
    values_ = np.array(values)
    n, cuts = len(texts), len(values_) - 1
    rank = np.searchsorted(values_, np.array(grades, np.int64)) if n else np.zeros(0, np.int64)
    share_from = np.array([(np.sum(rank >= k) + 0.5) / (n + 1) for k in range(1, cuts + 1)])
    thresholds = -np.log(share_from / (1 - share_from))
    thresholds += 1e-3 * np.arange(cuts)
    if not n:
        return Model(np.zeros(FEATURES), thresholds, values_)
    parts = []
    for a, b in slices(np.fromiter(map(len, texts), np.int64, n)):
        owner, feature, share = features(texts[a:b])
        keys, at = np.unique(owner * FEATURES + feature, return_inverse=True)
        counted = np.bincount(at, share).astype(np.float32)
        parts.append(((keys // FEATURES + a).astype(np.int32), (keys % FEATURES).astype(np.int32), counted))
    owner, feature, share = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    mean = np.bincount(feature, share, FEATURES) / n
    spread_of = np.sqrt(np.maximum(np.bincount(feature, share * share, FEATURES) / n - mean * mean, 0))
    scale = np.where(spread_of > 0, 1 / (spread_of + LEAST_SPREAD), 0)
    x = share * scale.astype(np.float32)[feature]
    centre = mean * scale
    weights = np.zeros(FEATURES)
    first, steps = thresholds[0], np.log(np.maximum(np.diff(thresholds), 1e-2))  # ordered: first + sums of exp(steps)
    moments = [[np.zeros_like(v), np.zeros_like(v)] for v in (weights, np.zeros(1), steps)]
    for t in range(1, rounds + 1):
        cut = first + np.concatenate([[0.0], np.cumsum(np.exp(steps))])
        latent = np.bincount(owner, weights[feature] * x, n) - weights @ centre
        tail = 1 / (1 + np.exp(-np.clip(latent[:, None] - cut[None, :], -40, 40)))
        edge = np.concatenate([np.ones((n, 1)), tail, np.zeros((n, 1))], 1)
        slope = edge * (1 - edge)
        row = np.arange(n)
        p = np.maximum(edge[row, rank] - edge[row, rank + 1], 1e-12)
        to_latent = -(slope[row, rank] - slope[row, rank + 1]) / p / n
        to_cut = np.zeros(cuts + 2)
        np.add.at(to_cut, rank, slope[row, rank] / p / n)
        np.add.at(to_cut, rank + 1, -slope[row, rank + 1] / p / n)
        to_cut = to_cut[1 : cuts + 1]
        to_weights = np.bincount(feature, to_latent[owner] * x, FEATURES) - to_latent.sum() * centre + decay * weights
        to_steps = np.cumsum(to_cut[::-1])[::-1][1:] * np.exp(steps)
        moved = []
        for g, m in zip((to_weights, np.array([to_cut.sum()]), to_steps), moments, strict=True):
            m[0] += 0.1 * (g - m[0])
            m[1] += 0.01 * (g * g - m[1])
            moved.append(rate * (1 - t / rounds / 1.1) * (m[0] / (1 - 0.9**t)) / (np.sqrt(m[1] / (1 - 0.99**t)) + 1e-8))
        weights -= 0.1 * moved[0]
        first -= moved[1][0]
        steps = steps - moved[2]
    cut = first + np.concatenate([[0.0], np.cumsum(np.exp(steps))])
    return Model(weights * scale, cut + weights @ centre, values_)


def fitted(docs: DataFrame, labels: DataFrame, column: str = "quality", grades: tuple[int, ...] = (0, 1), rows_per_grade: int = ROWS_PER_GRADE) -> bytes:
    """A model fitted on a bounded sample of the graded rows that are not held out."""
    values = sorted(grades)
    return fit(sample(docs, labels, column, values, rows_per_grade), lambda texts, given: train(texts, given, values).to_bytes())


_LOADED: dict[int, Model] = {}


def grader(docs: DataFrame, model: bytes, wanted: int) -> Callable[[Column], Column]:
    """A column expression: (expected grade, probability of the wanted grade or a higher one) of whole texts."""
    sent = shared(docs.sparkSession, model)

    @F.pandas_udf("expected double, tail double")
    def grade(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        data = sent.value
        if hash(data) not in _LOADED:
            _LOADED[hash(data)] = Model.of_bytes(data)
        loaded = _LOADED[hash(data)]
        gaps = np.diff(loaded.grades).astype(np.float64)
        which = int(np.searchsorted(loaded.grades, wanted)) - 1
        for batch in batches:
            texts = [t or "" for t in batch]
            parts = [loaded.tails(texts[a:b]) for a, b in slices(np.fromiter(map(len, texts), np.int64, len(texts)))]
            tails = np.concatenate(parts) if parts else np.zeros((0, len(gaps)))
            yield pd.DataFrame({"expected": loaded.grades[0] + tails @ gaps, "tail": tails[:, max(which, 0)] if which >= 0 else 1.0})

    return grade


def with_grades(docs: DataFrame, model: bytes, wanted: int = 1, text_column: str = "text") -> DataFrame:
    """All columns, expected_grade and p_wanted of each whole text."""
    both = unused(docs, "graded")
    return (
        docs.withColumn(both, grader(docs, model, wanted)(F.col(text_column).cast("string")))
        .withColumn("expected_grade", F.col(f"{both}.expected"))
        .withColumn("p_wanted", F.col(f"{both}.tail"))
        .drop(both)
    )


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, expected_grade, p_wanted and the decision on every document."""
    graded = with_grades(docs.select("doc_id", "text"), fitted(docs, labels))
    return graded.select(
        "doc_id", held_out("doc_id").alias("held_out"), "expected_grade", "p_wanted", (F.col("p_wanted") >= KEEP_FROM).alias("kept")
    )


def select_good(docs: DataFrame, model: bytes, wanted: int = 1, text_column: str = "text") -> DataFrame:
    """All columns of the documents that reach the wanted grade with a probability of at least KEEP_FROM."""
    graded = grader(docs, model, wanted)(F.col(text_column).cast("string"))
    return docs.where(graded["tail"] >= KEEP_FROM)
