"""Quality classifier: weak labellers, expectation-maximisation, a hashed linear scorer.

1. Overlapping heuristic labellers vote good, bad or abstain on each document.
2. The votes of all documents are counted by pattern (at most 3 ^ labellers rows).
   Expectation-maximisation on these counts estimates how often each labeller is
   right, and the share of good documents; it needs no labels. Each pattern then
   has a posterior.
3. A logistic scorer over hashed features (the shapes of words and of pairs of
   neighbours, and grades of repetition) is trained on the posteriors of a bounded
   sample, and scores every document.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylog.llm.common import table

#: Documents that the scorer is trained on, at most: those of smallest hash, one of equal rows.
TRAINING_ROWS = 4000
#: Features are hashed to so many places.
PLACES = 1 << 14
THRESHOLD = 0.5
GOOD, BAD, ABSTAIN = 1, 0, 2

_SHAPE = bytes(ord("a") if c >= 128 or chr(c).islower() else ord("A") if chr(c).isupper() else ord("9") if chr(c).isdigit() else c
               for c in range(256))
_RUNS = re.compile(rb"a+|A+|9+")


@dataclass(frozen=True)
class Facts:
    """What the labellers and the scorer look at; shares are of all words."""

    words: int
    plain: float        # letters only, but for marks that prose has
    shouted: float      # in capitals, of three letters or more
    marks: float        # marks that prose seldom has
    exclaimed: float    # double exclamation marks
    bars: float         # vertical bars
    repeated: float     # equal to the word before
    distinct: float     # different words
    sentences: float    # ends of sentences
    length: float       # mean characters of a word


_PROSE_MARKS = ".,;:?!()\"'-\u2019\u201c\u201d\u00ab\u00bb"


def facts(text: str) -> tuple[Facts, list[str]]:
    words = text.split()
    n = max(1, len(words))
    return Facts(
        len(words), sum(w.strip(_PROSE_MARKS).isalpha() for w in words) / n, sum(w.isupper() for w in words if len(w) > 2) / n,
        sum(map(text.count, "#$%&*^~\\{}<>")) / n, text.count("!!") / n, text.count("|") / n,
        sum(map(operator.eq, words, words[1:])) / n, len(set(words)) / n,
        sum(map(text.count, ".!?")) / n, sum(map(len, words)) / n), words


def _vote(bad: bool, good: bool = False) -> int:
    return BAD if bad else GOOD if good else ABSTAIN


def votes(f: Facts) -> tuple[int, ...]:
    """The votes of the labellers; on an empty text, all but one abstain."""
    long = f.words >= 30
    again = f.repeated * f.words > 1.5  # twice at least
    calm = not (f.repeated >= 0.05 and again) and f.shouted < 0.1 and f.exclaimed < 0.02
    return (
        _vote(f.words == 0 or f.plain < 0.8, f.plain > 0.95 and calm),
        _vote(long and not 0.01 <= f.sentences <= 0.6, 0.02 < f.sentences < 0.35 and calm and f.marks + f.bars < 0.02),
        _vote(f.words > 0 and not 2.5 <= f.length <= 14, calm and f.plain > 0.9 and f.marks + f.bars < 0.02),
        _vote(long and f.distinct < 0.25),
        _vote(f.shouted > 0.3),
        _vote(f.exclaimed > 0.1),
        _vote(f.marks > 0.15),
        _vote(f.bars > 0.05),
        _vote(f.marks + f.bars > 0.1),
        _vote(f.repeated > 0.08 and again),
        _vote(f.repeated > 0.05 and again or long and f.distinct < 0.15),
    )


LABELLERS = len(votes(facts("")[0]))


def _pattern(v: tuple[int, ...]) -> int:
    return sum(x * 3**i for i, x in enumerate(v))


@dataclass
class VoteModel:
    """``good``: share of good documents; ``right``: how often each labeller is right when it votes."""

    good: float
    right: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """The chance that a document of each pattern is good."""
        v = patterns[:, None] // 3 ** np.arange(LABELLERS) % 3
        odds = np.log(self.right / (1 - self.right))
        z = np.log(self.good / (1 - self.good)) + (v == GOOD) @ odds - (v == BAD) @ odds
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> VoteModel:
    """Expectation-maximisation from the belief that each labeller is right four times out of five."""
    model = VoteModel(0.5, np.full(LABELLERS, 0.8))
    v = patterns[:, None] // 3 ** np.arange(LABELLERS) % 3
    for _ in range(rounds if len(patterns) else 0):
        p = model.posterior(patterns)
        hits = counts @ ((v == GOOD) * p[:, None] + (v == BAD) * (1 - p)[:, None])
        cast = counts @ (v != ABSTAIN)
        # ten votes of the first belief stay, so a labeller that seldom votes is not thought perfect
        right = np.clip((hits + 8) / (cast + 10), 0.51, 0.99)
        good = float(np.clip((counts @ p + 1) / (counts.sum() + 2), 0.01, 0.99))
        done = max(np.abs(right - model.right).max(), abs(good - model.good)) < 1e-7
        model = VoteModel(good, right)
        if done:
            break
    return model


def features(text: str, f: Facts, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features: places (sorted, distinct) and values, of length 1 together."""
    shapes = _RUNS.sub(lambda m: m.group()[:1], text.encode("utf-8", "replace").translate(_SHAPE)).split()
    got = Counter(shapes)
    got.update(zip(shapes, shapes[1:]))
    n = max(1, len(shapes))
    values: dict[int, float] = {}
    for key, count in got.items():
        at = zlib.crc32(key if isinstance(key, bytes) else b" ".join(key)) % PLACES
        values[at] = values.get(at, 0.0) + count / n
    for name, x in (("r", f.repeated), ("d", f.distinct), ("l", f.length / 10), ("s", f.sentences)):
        at = zlib.crc32(f"{name}{min(20, int(20 * x))}".encode()) % PLACES
        values[at] = values.get(at, 0.0) + 0.5
    places = np.array(sorted(values), np.int32)
    x = np.sqrt([values[i] for i in places.tolist()])
    return places, x / max(1e-9, float(np.linalg.norm(x)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, rounds: int = 300, rate: float = 0.3,
          decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by gradient steps with a rate of its own for each weight (Adam)."""
    if not rows:
        return np.zeros(PLACES), 0.0
    at = np.concatenate([p for p, _ in rows])
    x = np.concatenate([v for _, v in rows])
    row = np.repeat(np.arange(len(rows)), [len(p) for p, _ in rows])
    w, m, v = (np.zeros(PLACES + 1) for _ in range(3))
    for i in range(1, rounds + 1):
        z = np.bincount(row, x * w[at], len(rows)) + w[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - good) / len(rows)
        g = np.append(np.bincount(at, x * error[row], PLACES), error.sum()) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-9)
    return w[:-1], float(w[-1])


@dataclass
class QualityModel:
    """The vote model, and the weights of the scorer."""

    votes: VoteModel
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> tuple[float, float]:
        """The scorer's chance that a document is good, and the posterior of its votes."""
        f, words = facts(text or "")
        places, x = features(text or "", f, words)
        z = float(self.weights[places] @ x) + self.bias
        return 1 / (1 + float(np.exp(-np.clip(z, -50, 50)))), float(self.votes.posterior(np.array([_pattern(votes(f))]))[0])


def fit(docs: DataFrame, sample: int = TRAINING_ROWS) -> QualityModel:
    """Fit on ``docs`` (doc_id, text): votes of all of it, the scorer on ``sample`` rows."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("doc_id", "text").alias("mark"))

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = Counter(_pattern(votes(facts(t.as_py())[0])) for t in b.column("text"))
            yield pa.RecordBatch.from_pydict({"pattern": pa.array(list(got), pa.int32()), "n": pa.array(list(got.values()), pa.int64())})

    counted = texts.select("text").mapInArrow(patterns, "pattern int, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    model = estimate(np.array([r.pattern for r in counted], np.int64), np.array([r.n for r in counted], float))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b.column("text"):
                f, words = facts(t.as_py())
                places, x = features(t.as_py(), f, words)
                out.append((places.tobytes(), x.astype("<f4").tobytes(), _pattern(votes(f))))
            yield pa.RecordBatch.from_pydict({k: pa.array([r[i] for r in out], kind) for i, (k, kind) in enumerate(
                (("places", pa.binary()), ("x", pa.binary()), ("pattern", pa.int32())))})

    marks = texts.select("mark").distinct().orderBy("mark").limit(sample).agg(F.max("mark")).first()[0]
    chosen = texts.filter(F.col("mark") <= F.lit(marks)).groupBy("mark").agg(F.first("text").alias("text"))
    rows = [] if marks is None else chosen.mapInArrow(prepare, "places binary, x binary, pattern int").collect()
    rows.sort(key=lambda r: (r.places, r.x))  # the sums of the training come in one order
    posterior = model.posterior(np.array([r.pattern for r in rows], np.int64)) if rows else np.zeros(0)
    w, bias = train([(np.frombuffer(r.places, np.int32), np.frombuffer(r.x, "<f4").astype(float)) for r in rows], posterior)
    return QualityModel(model, w, bias)


def classify(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``quality_score``, ``label_posterior`` (doubles) and ``keep`` (boolean) to ``docs``; columns of these names are replaced.

    A null text counts as empty. Whole texts are read, however long. The rows are neither moved nor dropped, repeated
    ones are scored alike, and an empty table gives no rows. A column named __made is not allowed.
    """
    @F.arrow_udf("quality_score double, label_posterior double")
    def apply(texts: pa.Array) -> pa.Array:
        got = [model.score(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([a for a, _ in got], pa.float64()), pa.array([b for _, b in got], pa.float64())],
                                          names=["quality_score", "label_posterior"])

    made = ("quality_score", "label_posterior", "keep")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in made]
    return docs.withColumn("__made", apply(F.col("text"))).select(
        *kept, "__made.*", (F.col("__made.quality_score") >= threshold).alias("keep"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores of all ``documents`` and whether each is kept, by a model fitted on them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(docs, fit(docs)).select("doc_id", "quality_score", "label_posterior", "keep")
