"""Toxicity: cumulative-link ordinal regression on sparse text features.

A document has severity grade y of 0 to g. One weight vector serves all grades:
P(y <= k) = sigmoid(t_k - w . x) with ordered thresholds t_0 < t_1 < ... The features x
are the words of the document and their beginnings, hashed, each there or not; those
that tell nothing about the grade in the sample get no weight. The output is the expected
severity, the sum of k P(y = k), the likeliest grade, and whether P(y >= 1) is at
least one half.

The model is fitted on a bounded sample of labelled rows; all rows are scored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylog.llm.common import table

#: Labelled documents that the model is fitted on, at most: those of smallest hash.
TRAINING_ROWS = 8000
#: Words are hashed to so many places.
PLACES = 1 << 18
#: A feature needs so many training documents.
LEAST_DOCUMENTS = 8
#: A feature's documents have a mean grade above that of all by so many standard errors.
LEAST_SIGNAL = 5.0
#: Words whose place a worker remembers.
REMEMBERED = 1 << 18

_WORD = re.compile(r"[^\W\d_]{2,40}")


def word_places(word: str) -> list[int]:
    """The places of a word: of itself, and of its beginnings, which inflected words share."""
    return [xxhash.xxh32_intdigest(f) % PLACES for f in (word, *(word[:n] + "*" for n in range(3, min(8, len(word) - 1) + 1)))]


def text_places(text: str | None) -> np.ndarray:
    """The places of the words of a text (sorted, distinct)."""
    words = set(_WORD.findall((text or "").lower()))
    return np.unique(np.fromiter((p for w in words for p in word_places(w)), np.int32))


@dataclass
class OrdinalModel:
    """Weights by place, and the ordered thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def grades(self, places: np.ndarray) -> np.ndarray:
        """The chance of each grade."""
        return self.grades_at(float(self.weights[places].sum()))

    def grades_at(self, z: float) -> np.ndarray:
        upto = 1 / (1 + np.exp(-np.clip(self.thresholds - z, -50, 50)))
        return np.diff(np.concatenate([[0.0], upto, [1.0]]))


class Scorer:
    """The weighted places of words, remembered up to a number; most words have none."""

    def __init__(self, model: OrdinalModel):
        self.model, self.known = model, {}

    def grades(self, text: str | None) -> np.ndarray:
        words = set(_WORD.findall((text or "").lower()))
        known, weights = self.known, self.model.weights
        if len(known) > REMEMBERED:
            known.clear()
        hit: set[int] = set()
        for w in words:
            places = known.get(w)
            if places is None:
                places = known[w] = tuple(p for p in word_places(w) if weights[p])
            if places:
                hit.update(places)
        return self.model.grades_at(float(sum(weights[p] for p in sorted(hit))))


def _standard_errors(at: np.ndarray, row: np.ndarray, grades: np.ndarray, holding: np.ndarray) -> np.ndarray:
    """By how many standard errors the mean grade of the documents that hold a feature exceeds that of all."""
    mean = np.bincount(at, grades[row], PLACES) / np.maximum(1, holding)
    return (mean - grades.mean()) / (max(1e-9, grades.std()) / np.sqrt(np.maximum(1, holding)))


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, classes: int, rounds: int = 600, rate: float = 0.1,
                decay: float = 1e-6) -> OrdinalModel:
    """Fit weights and thresholds to ``grades`` (0 to classes - 1) of documents given by their places.

    Gradient steps with a rate of its own for each parameter (Adam), all documents
    in each. A feature can only add to severity: weights stay at 0 or above. The thresholds are the first and
    the logarithms of the steps to the others, so they stay in order.
    """
    if not rows or classes < 2:
        return OrdinalModel(np.zeros(PLACES), np.arange(max(1, classes - 1)) + 4.0)
    at = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    holding = np.bincount(at, minlength=PLACES)
    telling = (holding >= LEAST_DOCUMENTS) & (_standard_errors(at, row, grades, holding) > LEAST_SIGNAL)
    at, row = at[telling[at]], row[telling[at]]
    used, at = np.unique(at, return_inverse=True)
    n, d, steps = len(rows), len(used), classes - 2
    cost = np.full(n, 1 / n)
    p = np.zeros(d + 1 + steps)
    m, v = np.zeros_like(p), np.zeros_like(p)
    # start from half the log odds of each feature, as features come several together
    some = np.bincount(at, (grades > 0)[row], d)
    rest = np.bincount(at, minlength=d) - some
    p[:d] = 0.5 * np.log(((some + 0.5) / ((grades > 0).sum() + 1)) / ((rest + 0.5) / ((grades == 0).sum() + 1)))
    p[d] = 3.0

    def sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -50, 50)))

    for i in range(1, rounds + 1):
        w, t = p[:d], p[d] + np.concatenate([[0.0], np.cumsum(np.exp(p[d + 1:]))])
        z = np.bincount(row, w[at], n)
        edges = np.concatenate([[-np.inf], t, [np.inf]])
        hi, lo = sigmoid(edges[grades + 1] - z), sigmoid(edges[grades] - z)
        chance = np.maximum(hi - lo, 1e-12)
        slope_hi, slope_lo = hi * (1 - hi) / chance, lo * (1 - lo) / chance
        gw = np.bincount(at, (cost * (slope_hi - slope_lo))[row], d) + decay * w
        gt = np.array([-(cost * slope_hi)[grades == k].sum() + (cost * slope_lo)[grades == k + 1].sum() for k in range(classes - 1)])
        g = np.concatenate([gw, [gt.sum()], [np.exp(p[d + 1 + j]) * gt[j + 1:].sum() for j in range(steps)]])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p -= rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-9)
        p[:d] = np.maximum(0.0, p[:d])
    weights = np.zeros(PLACES)
    weights[used] = p[:d]
    return OrdinalModel(weights, p[d] + np.concatenate([[0.0], np.cumsum(np.exp(p[d + 1:]))]))


def severity_grades(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Grades from a yes-or-no label: 0 not toxic; of the toxic, 2 those with more telling features than the median, else 1.

    Telling: in at least 1 of 100 toxic documents, and there twenty times as often as elsewhere.
    """
    counts = [np.bincount(np.concatenate([p for p, y in zip(rows, toxic) if y == k] or [np.zeros(0, np.int32)]), minlength=PLACES)
              for k in (0, 1)]
    n = [max(1, int((toxic == k).sum())) for k in (0, 1)]
    telling = (counts[1] >= max(3, n[1] / 100)) & ((counts[1] + 0.5) / n[1] > 20 * (counts[0] + 0.5) / n[0])
    held = np.array([telling[p].sum() for p in rows])
    middle = np.median(held[toxic == 1]) if (toxic == 1).any() else 0.0
    return np.where(toxic == 1, np.where(held > middle, 2, 1), 0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = TRAINING_ROWS) -> OrdinalModel:
    """Fit on at most ``sample`` labelled rows: ``docs`` (doc_id, text), ``labels`` (doc_id, toxic 0 or 1).

    Rows without a label, or with a null one, are not trained on; of several labels
    of a doc_id the largest counts, and of rows of equal features and label one. Whole
    texts are read, however long; empty tables give a model that knows no words.
    """
    chosen = (labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            places = [text_places(t.as_py()).tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(places, pa.binary())],
                                             names=["doc_id", "toxic", "places"])

    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows of two numbers
    one = texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    got = one.mapInArrow(prepare, "doc_id long, toxic int, places binary").collect()
    got.sort(key=lambda r: r.doc_id)  # the sums of the fit come in one order
    got = list({(r.places, r.toxic > 0): r for r in reversed(got)}.values())[::-1]  # of rows with equal features and label one stays
    rows = [np.frombuffer(r.places, np.int32) for r in got]
    toxic = np.array([int(r.toxic > 0) for r in got], np.int64)
    return fit_ordinal(rows, severity_grades(rows, toxic) if rows else toxic, 3)


def grade(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """Add ``expected_severity`` (double), ``severity`` (int, the likeliest grade), ``toxic_chance`` (double) and
    ``toxic`` (boolean) to ``docs``; columns of these names are replaced.

    A null or empty text has no words: it gets what the thresholds alone say. Whole texts are read, however long. The
    rows are neither moved nor dropped, repeated ones are graded alike, and an empty table gives no rows. A column named
    __made is not allowed.
    """
    fields = {"expected_severity": pa.float64(), "severity": pa.int32(), "toxic_chance": pa.float64(), "toxic": pa.bool_()}

    @F.arrow_udf("expected_severity double, severity int, toxic_chance double, toxic boolean")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for texts in batches:
            p = np.array([scorer.grades(t.as_py()) for t in texts]).reshape(len(texts), -1)
            columns = [p @ np.arange(p.shape[1]), p.argmax(1), 1 - p[:, 0], p[:, 0] <= 0.5]
            yield pa.StructArray.from_arrays([pa.array(c, kind) for c, kind in zip(columns, fields.values())], names=list(fields))

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in fields]
    return docs.withColumn("__made", apply(F.col("text"))).select(*kept, "__made.*")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severities of all ``documents``, by a model fitted on labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return grade(docs, fit(docs, table(spark, sf_dir, "labels"))).drop("text")
