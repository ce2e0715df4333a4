"""Quality classifier: ordinal regression with cumulative links on graded ratings.

A rating has the grades 0 (toxic), 1 (poor) and 2 (good). One weight per hashed token is shared by
all grades; ordered thresholds cut the score: P(grade > k) = sigmoid(score - threshold k). The
expected grade is the sum of these tail probabilities, and the tail above the last threshold is the
probability that documents are selected by.

A text's features are its distinct tokens (letter runs in lower case, digit runs, punctuation
runs), the first four letters of its words, and marks for how many tokens repeat the one before,
how many are signs and how many are distinct, hashed to 2 ** ``BITS`` weights. Training reads the whole texts of about
``TRAINING_DOCS`` labelled documents, chosen by a hash of doc_id (fewer if there are fewer labels);
only tokens in ``MIN_DOCS`` of them, whose mean grade lies ``MIN_Z`` standard errors off the mean of
all, get a weight. The driver holds these tokens' numbers, which the
sample bounds, and fits by full-batch gradient steps with a fixed order, so the model repeats
exactly. Scoring reads every text whole.

Defined cases: null and empty texts and texts without tokens get grade 0 and are not kept; labels
with a null are not used, of several labels of one document the lowest grade counts; without
labels all thresholds stay at their start; equal texts get equal scores; other columns are kept by
``score`` unless they have the name of an output.
"""

from __future__ import annotations

import re
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read, slices

BITS = 20
TRAINING_DOCS = 6000
MIN_DOCS = 4
MIN_Z = 4.0
GRADES = 3
KEEP_FROM = 0.5
tokens = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+").findall


class _Slots(dict):
    """Hash slot of each token, remembered while there are not too many."""

    def __missing__(self, token: str) -> int:
        slot = xxhash.xxh3_64_intdigest(token) & (1 << BITS) - 1
        if len(self) < 120_000:
            self[token] = slot
        return slot


_slots = _Slots()


def _features(words: list[str]) -> set[str]:
    """Distinct tokens, word beginnings, and marks for repetition."""
    found = set(words)
    if not found:
        return found
    marks = {f"repeat {10 * sum(map(eq, words, words[1:])) // len(words)}", f"signs {10 * sum(not w[0].isalnum() for w in words) // len(words)}"}
    if len(words) >= 30:
        marks.add(f"distinct {10 * len(found) // len(words)}")
    return found.union({w[:4] + "-" for w in found if len(w) > 4}, marks)


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the distinct tokens of all texts, and the offsets of the texts."""
    sets = [_features(tokens((t or "").lower())) for t in texts]
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    flat = np.fromiter((_slots[t] for s in sets for t in s), np.int32, int(at[-1]))
    return flat, at


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])[at])


def _thresholds(x: np.ndarray) -> np.ndarray:
    """Ordered thresholds from the first one and the logs of the gaps."""
    return x[0] + np.concatenate([[0.0], np.cumsum(np.exp(x[1:]))])


class Model:
    """Weights by slot and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    @classmethod
    def fit(cls, slots: list[np.ndarray], grades: np.ndarray, steps: int = 200, rate: float = 0.08, ridge: float = 0.02) -> Model:
        """Maximum likelihood with a ridge on the weights (Adam on all rows)."""
        weights = np.zeros(1 << BITS)
        if not len(grades):
            return cls(weights.astype(np.float32), np.arange(GRADES - 1) + 0.0)
        docs = np.bincount(np.concatenate(slots), minlength=1 << BITS)
        centred = grades - grades.mean()
        sums = np.bincount(np.concatenate(slots), np.repeat(centred, [len(s) for s in slots]), minlength=1 << BITS)
        z = np.abs(sums) / np.sqrt(np.maximum(docs, 1) * max(centred.var(), 1e-9))
        used = np.flatnonzero((docs >= MIN_DOCS) & (z >= MIN_Z))
        number = np.full(1 << BITS, -1)
        number[used] = np.arange(len(used))
        slots = [number[s] for s in slots]
        slots = [s[s >= 0] for s in slots]
        flat, at = np.concatenate(slots), np.concatenate([[0], np.cumsum([len(s) for s in slots])])
        # parameters: weights, first threshold, logs of the gaps between thresholds
        share = np.clip([(grades > k).mean() for k in range(GRADES - 1)], 1e-3, 1 - 1e-3)
        start = -np.log(share / (1 - share))
        gaps = np.log(np.maximum(np.diff(start), 0.1))
        x = np.concatenate([np.zeros(len(used)), start[:1], gaps])
        m, v = np.zeros_like(x), np.zeros_like(x)
        for step in range(1, steps + 1):
            grad = cls.objective(x, len(used), flat, at, grades, ridge)[1]
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            x = x + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        weights[used] = x[:len(used)]
        return cls(weights.astype(np.float32), _thresholds(x[len(used):]))

    @staticmethod
    def objective(x: np.ndarray, n: int, flat: np.ndarray, at: np.ndarray, grades: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
        """Mean log likelihood less the ridge, and its gradient, at x: n weights, the first threshold,
        logs of the gaps between thresholds. ``flat`` holds the weights' numbers of row after row."""
        score = _sums(x[:n][flat], at)
        row, take = np.repeat(np.arange(len(grades)), np.diff(at)), np.arange(len(grades))
        # tail[:, k] = P(grade > k - 1), from 1 to 0
        inner = 1 / (1 + np.exp(-np.clip(score[:, None] - _thresholds(x[n:]), -30, 30)))
        tail = np.concatenate([np.ones((len(grades), 1)), inner, np.zeros((len(grades), 1))], 1)
        slope = tail * (1 - tail)
        p = np.maximum(tail[take, grades] - tail[take, grades + 1], 1e-9)
        upper, lower = slope[take, grades] / p, slope[take, grades + 1] / p
        by_score = upper - lower
        by_theta = np.zeros((len(grades), GRADES + 1))
        by_theta[take, grades] -= upper
        by_theta[take, grades + 1] += lower
        by_theta = by_theta[:, 1:-1].sum(0)
        shrink = ridge * len(grades) / 100
        value = np.log(p).sum() - shrink / 2 * (x[:n] ** 2).sum()
        grad = np.concatenate([
            np.bincount(flat, by_score[row], n) - shrink * x[:n],
            [by_theta.sum()], [by_theta[k + 1:].sum() * np.exp(x[n + 1 + k]) for k in range(GRADES - 2)]])
        return value / len(grades), grad / len(grades)

    def tails(self, texts: list[str | None]) -> np.ndarray:
        """P(grade > k) of every text; 0 without tokens."""
        flat, at = features(texts)
        score = _sums(self.weights[flat], at)
        tail = 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds, -30, 30)))
        return np.where(np.diff(at)[:, None] > 0, tail, 0.0)


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): toxic 0, poor 1, good 2."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    return labels.dropna(subset=["doc_id", "quality", "toxic"]).groupBy("doc_id").agg(F.min(grade).alias("grade"))


def train(docs: DataFrame, ratings: DataFrame, most: int = TRAINING_DOCS) -> Model:
    """Fit on about ``most`` rated documents; ``ratings``: (doc_id, grade)."""
    share = min(1.0, most / max(1, ratings.count()))
    chosen = ratings.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "grade").agg(F.min("text").alias("text"))          # a doc_id that repeats counts once

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                flat, at = features(batch.column("text").to_pylist())
                slots = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("grade").cast(pa.int32()), slots], ["doc_id", "grade", "slots"])

    got = rows.mapInArrow(run, "doc_id long, grade int, slots array<int>").toArrow().sort_by("doc_id")
    slots = [np.sort(np.asarray(s, np.int64)) for s in got.column("slots").to_pylist()]
    return Model.fit(slots, got.column("grade").to_numpy().astype(np.int64))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Append expected_grade, tail_probability (of the best grade) and keep."""
    shared = docs.sparkSession.sparkContext.broadcast(model)          # 2 ** BITS numbers
    names = ("expected_grade", "tail_probability", "keep")
    keep = [f for f in docs.schema.fields if f.name not in names]
    schema = T.StructType([*keep, *(T.StructField(n, T.DoubleType()) for n in names[:2]), T.StructField(names[2], T.BooleanType())])

    def run(batches):
        for whole in batches:
            for batch in slices(whole, text):
                tail = shared.value.tails(batch.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in keep), pa.array(tail.sum(1)), pa.array(tail[:, -1]), pa.array(tail[:, -1] >= KEEP_FROM)], schema.names)

    return docs.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and selection of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, graded(read(spark, sf_dir, "labels")))
    return score(docs, model).select("doc_id", "expected_grade", "tail_probability", "keep")
