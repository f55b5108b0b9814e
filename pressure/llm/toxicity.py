"""Toxicity scores from subword-bag embeddings.

A word is the bag of its character n-grams and of itself, with marks at both ends; each hashes to a
row of one embedding table, and the rows are averaged into the word's vector. The vectors of the most toxic words of a span of
SPAN words, one in every WORDS_PER_PICK, are averaged and a linear softmax over the average gives the span's
probability. A shorter text is one span; a longer one has a span at every WORDS_PER_PICK words and one at its end, and scores as
its most toxic span, so what is added to a text does not thin out what was there. The plain average over all words of
a span catches fewer toxic texts (figures in the README). Table and softmax are fitted together in
numpy, first on single words by the texts they occur in, then on the spans that speak for whole texts. A misspelling shares most
n-grams, and so most of its vector, with the word it comes from.

Only the text is an input of a score. Null and empty texts, and texts without a word, have an
average of nothing and score by the offsets alone. Rows are scored one by one; repeated rows score alike. Extra columns are kept
by `with_score`, and one of the score's own name is replaced.
"""

from __future__ import annotations

import io
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressure.llm.common import held_out, shared, slices, spread
from pressure.llm.labelled import ROWS_PER_GRADE, fit, sample

WORD = re.compile(r"\w*[^\W\d_]\w*")  # with a letter in it
WORDS_PER_PICK = 120
SPAN = 2 * WORDS_PER_PICK
SIZES = (3, 4, 5)
ROWS, WIDTH = 1 << 17, 8
THRESHOLD = 0.7
# Words whose scores a worker remembers before it forgets them all.
REMEMBERED = 600_000


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of every word itself and of its n-grams, one word after the other, and how many each has."""
    marked = [f"<{w}>" for w in words]
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    code = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    start = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(marked)), size)
    left = np.repeat(start + size, size) - np.arange(len(code))  # characters up to the word's end, this one included
    found, owners = [], []
    mixed = np.bitwise_xor.reduceat(code * np.uint64(0x94D049BB133111EB) * (2 * (np.arange(len(code)) - np.repeat(start, size)) + 1).astype(np.uint64), start) if len(marked) else code
    found.append(((mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - 17)).astype(np.int64))  # the word itself
    owners.append(np.arange(len(marked)))
    rolled = np.zeros(len(code), np.uint64)
    for n in range(1, max(SIZES) + 1):
        ahead = np.zeros(len(code), np.uint64)
        ahead[: max(len(code) - n + 1, 0)] = code[n - 1 :]
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + ahead + np.uint64(n)
        if n in SIZES:
            here = left >= n
            mixed = rolled[here] ^ (rolled[here] >> np.uint64(29))
            mixed = mixed * np.uint64(0xBF58476D1CE4E5B9)
            found.append((mixed >> np.uint64(64 - 17)).astype(np.int64))
            owners.append(owner[here])
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(found)[order], np.bincount(owners, minlength=len(marked))


def word_lists(texts: list[str]) -> list[list[str]]:
    return [WORD.findall(t.lower()) for t in texts]


def picked(values: np.ndarray) -> np.ndarray:
    """Places of the words that speak for a text with these word logits: the most toxic ones of its most toxic span."""
    n = len(values)
    if n <= SPAN:
        k = -(-n // WORDS_PER_PICK)
        return np.argpartition(values, n - k)[n - k :]
    starts = np.append(np.arange(0, n - SPAN, WORDS_PER_PICK), n - SPAN)
    k = SPAN // WORDS_PER_PICK
    spans = values[starts[:, None] + np.arange(SPAN)]
    top = np.argpartition(spans, SPAN - k, axis=1)[:, SPAN - k :]
    best = int(np.argmax(np.take_along_axis(spans, top, 1).sum(1)))
    return starts[best] + top[best]


class Model:
    """Embedding table (ROWS x WIDTH), softmax weights (2 x WIDTH) and offsets (2)."""

    def __init__(self, table: np.ndarray, weights: np.ndarray, offsets: np.ndarray):
        self.table, self.weights, self.offsets = table, weights, offsets
        # The softmax over two classes is a logistic of their difference; that is linear in the average.
        self.row_logit = self.table @ (self.weights[1] - self.weights[0])
        self.base = float(self.offsets[1] - self.offsets[0])
        self.known: dict[str, float] = {}

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, table=self.table.astype(np.float16), weights=self.weights, offsets=self.offsets)
        return out.getvalue()

    @staticmethod
    def of_bytes(data: bytes) -> Model:
        with np.load(io.BytesIO(data)) as parts:
            return Model(parts["table"].astype(np.float32), parts["weights"], parts["offsets"])

    def word_logits(self, words: list[str]) -> np.ndarray:
        rows, sizes = ngrams(words)
        return np.add.reduceat(self.row_logit[rows], np.cumsum(sizes) - sizes) / sizes if len(words) else np.zeros(0)

    def logits(self, lists: list[list[str]]) -> np.ndarray:
        """Logit of the average over the words that speak for each text."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set().union(*lists) - self.known.keys())
        self.known.update(zip(new, self.word_logits(new).tolist(), strict=True))
        out = np.full(len(lists), self.base)
        for i, words in enumerate(lists):
            if words:
                values = np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))
                out[i] += values[picked(values)].mean()
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(word_lists(texts)), -40, 40)))


class _Trainer:
    """Adagrad on table and softmax together; a bag is an average of word vectors, a word one of n-gram vectors."""

    def __init__(self, words: list[str], seed: int):
        self.rng = np.random.default_rng(seed)
        self.rows, self.sizes = ngrams(words)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.table = self.rng.normal(0, 0.05, (ROWS, WIDTH)).astype(np.float32)
        self.weights = self.rng.normal(0, 0.5, (2, WIDTH)).astype(np.float32)
        self.offsets = np.zeros(2, np.float32)
        self.seen = [np.full_like(x, 1e-8) for x in (self.table, self.weights, self.offsets)]

    def word_logits(self) -> np.ndarray:
        row_logit = self.table @ (self.weights[1] - self.weights[0])
        return np.add.reduceat(row_logit[self.rows], self.starts) / self.sizes

    def step(self, words: np.ndarray, bag: np.ndarray, labels: np.ndarray, weight: np.ndarray, rate: float, dropped: float) -> None:
        """One step on bags of words (bag: that of each word, ascending, none empty). A share of the n-grams is
        left out, so that words known in part, as misspellings are, count as well."""
        per_bag = np.bincount(bag, minlength=len(labels))
        words, place = np.unique(words, return_inverse=True)
        sizes = self.sizes[words]
        owner = np.repeat(np.arange(len(words)), sizes)
        row = self.rows[spread(self.starts[words], sizes)]
        kept = self.rng.random(len(row)) >= dropped
        row, owner = row[kept], owner[kept]
        left = np.maximum(np.bincount(owner, minlength=len(words)), 1)
        used, at = np.unique(row, return_inverse=True)
        vectors = np.zeros((len(words), WIDTH))
        np.add.at(vectors, owner, self.table[used][at])
        vectors /= left[:, None]
        mean = np.add.reduceat(vectors[place], np.cumsum(per_bag) - per_bag) / per_bag[:, None]
        scores = mean @ self.weights.T + self.offsets
        p = np.exp(scores - scores.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(labels)), labels] -= 1
        p *= weight[:, None]
        to_mean = (p @ self.weights) / per_bag[:, None]
        to_words = np.zeros_like(vectors)
        np.add.at(to_words, place, to_mean[bag])
        to_table = np.zeros((len(used), WIDTH))
        np.add.at(to_table, at, (to_words / left[:, None])[owner])
        seen = self.seen[0]
        seen[used] += to_table * to_table
        self.table[used] -= rate * to_table / np.sqrt(seen[used])
        for x, g, s in zip((self.weights, self.offsets), (p.T @ mean, p.sum(0)), self.seen[1:], strict=True):
            s += g * g
            x -= 0.2 * rate * g / np.sqrt(s)

    def batches(self, n: int, size: int) -> Iterator[np.ndarray]:
        order = self.rng.permutation(n)
        for a in range(0, n, size):
            yield order[a : a + size]


def train(texts: list[str], grades: list[int], rounds: int = 16, seed: int = 10) -> Model:
    """Fits the model. Without a word to learn from it scores every text by the class it has seen."""
    lists = word_lists(texts)
    vocabulary = sorted(set().union(*lists)) if lists else []
    labels = np.array(grades, np.int64)
    if not vocabulary or labels.min() == labels.max():
        offsets = np.array([0.0, 4.0 if len(labels) and labels.all() else -4.0], np.float32)
        return Model(np.zeros((ROWS, WIDTH), np.float32), np.zeros((2, WIDTH), np.float32), offsets)
    trainer = _Trainer(vocabulary, seed)
    number = {w: i for i, w in enumerate(vocabulary)}
    ids = np.array([number[w] for words in lists for w in words], np.int64)
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    text_of = np.repeat(np.arange(len(lists)), counts)

    # First the words, each by the share of the texts of either class that have it.
    pairs = np.unique(text_of * len(vocabulary) + ids)
    has, by_class = pairs % len(vocabulary), np.zeros((2, len(vocabulary)))
    for c in (0, 1):
        own = has[labels[pairs // len(vocabulary)] == c]
        by_class[c] = np.bincount(own, minlength=len(vocabulary)) / max(1, (labels == c).sum())
    by_class += 2 / min((labels == 0).sum(), (labels == 1).sum())  # a word of one text or two says little
    scale = 1 / by_class.mean()
    for _ in range(3):
        for some in trainer.batches(len(vocabulary), 8192):
            words = np.concatenate([some, some])
            labels_of = np.repeat([0, 1], len(some))
            trainer.step(words, np.arange(len(words)), labels_of, scale * by_class[:, some].ravel(), 0.3, 0.0)
    for seen in trainer.seen:
        seen[:] = 1e-2

    # Then the texts by the words that speak for them, and clean texts also by some other words of theirs.
    start = np.cumsum(counts) - counts
    take = np.minimum(-(-counts // WORDS_PER_PICK), SPAN // WORDS_PER_PICK)
    weight = np.sqrt(len(labels) / 2 / np.bincount(labels, minlength=2))[labels]
    for k in range(rounds):
        value = trainer.word_logits()[ids]
        top_of = [s + picked(value[s : s + n]) if n else np.zeros(0, np.int64) for s, n in zip(start, counts, strict=True)]
        for some in trainer.batches(len(lists), 256):
            some = some[counts[some] > 0]
            clean = some[labels[some] == 0]
            top = np.concatenate([top_of[i] for i in some]) if len(some) else np.zeros(0, np.int64)
            other = spread(start[clean] + (trainer.rng.random(len(clean)) * (counts[clean] - take[clean] + 1)).astype(int), take[clean])
            bag = np.repeat(np.arange(len(some) + len(clean)), np.concatenate([take[some], take[clean]]))
            of = np.concatenate([some, clean])
            trainer.step(ids[np.concatenate([top, other])], bag, labels[of], weight[of], 0.3 * (1 - k / rounds) + 0.02, 0.2)
    return Model(trainer.table, trainer.weights, trainer.offsets)


def fitted(docs: DataFrame, labels: DataFrame, rows_per_grade: int = ROWS_PER_GRADE) -> bytes:
    """A model fitted on a bounded sample of the labelled rows that are not held out."""
    return fit(sample(docs, labels, "toxic", [0, 1], rows_per_grade), lambda texts, grades: train(texts, grades).to_bytes())


_LOADED: dict[int, Model] = {}


def scorer(docs: DataFrame, model: bytes) -> Callable[[Column], Column]:
    """A column expression that scores whole texts."""
    sent = shared(docs.sparkSession, model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        data = sent.value
        if hash(data) not in _LOADED:
            _LOADED[hash(data)] = Model.of_bytes(data)
        loaded = _LOADED[hash(data)]
        for batch in batches:
            texts = [t or "" for t in batch]
            parts = [loaded.scores(texts[a:b]) for a, b in slices(np.fromiter(map(len, texts), np.int64, len(texts)))]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return score


def with_score(docs: DataFrame, model: bytes, text_column: str = "text", name: str = "score") -> DataFrame:
    """All columns and the score of each whole text, 0 to 1."""
    return docs.withColumn(name, scorer(docs, model)(F.col(text_column).cast("string")))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and prediction of every document."""
    scored = with_score(docs.select("doc_id", "text"), fitted(docs, labels))
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def select_clean(docs: DataFrame, model: bytes, text_column: str = "text") -> DataFrame:
    """All columns of the documents that score below THRESHOLD."""
    return docs.where(scorer(docs, model)(F.col(text_column).cast("string")) < THRESHOLD)
