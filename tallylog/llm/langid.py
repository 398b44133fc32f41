"""Language identification by interpolated Kneser-Ney character models.

1. Texts are lower-cased; letters stay, and each run of other characters becomes one
   space. All character n-grams of all learning texts are counted by language.
2. In DataFrames over the distinct n-grams: the lower orders take the number of
   different characters before an n-gram in place of its count, each order and language
   has its discount n1 / (n1 + 2 n2), and each context its total and number of kinds.
3. The counts are stored in sorted hash arrays: a language and n-gram has one of 2^SLOT_BITS
   slots in each order, so a model has that many entries an order at most, however
   large the corpus; n-grams that share a slot add up.
4. A text goes to the language of lowest cross-entropy a character.
5. Calibration, on learning texts that a second model has not counted: a logistic curve
   turns the evidence (the distance in bits to the next language) into the chance that the
   answer is right, and a text is rejected whose cross-entropy lies beyond nearly all
   those of its language.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylog.llm.common import stage, table

ORDER = 4
SLOT_BITS = 22
#: Characters that are worked on at once.
SEGMENT = 1 << 19
#: n-grams whose probabilities a task keeps.
KEPT = 1 << 18
#: The share of a language's own texts that may be rejected.
REJECTED = 0.001
UNDETERMINED = "und"

_FACTOR = 0x9E3779B97F4A7C15
_POWERS = [pow(_FACTOR, i, 1 << 64) for i in range(ORDER)]
_NOT_LETTER = re.compile(r"[\W\d_]")


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def segments(text: str, size: int = SEGMENT) -> list[str]:
    """A text as it is; a long one cut after non-letters (within a word that is longer than a segment)."""
    out, at = [], 0
    while len(text) - at > size:
        found = _NOT_LETTER.search(text, at + size, at + 2 * size)
        end = found.end() if found else min(at + 2 * size, len(text))
        out.append(text[at:end])
        at = end
    return [*out, text[at:]]


def grouped(texts: Iterator[str | None] | list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Segments of texts, with the place of their text, in groups of about SEGMENT characters."""
    places, parts, held = [], [], 0
    for i, text in enumerate(texts):
        for s in segments(text) if text else ():
            places.append(i)
            parts.append(s)
            held += len(s)
            if held >= SEGMENT:
                yield places, parts
                places, parts, held = [], [], 0
    if parts:
        yield places, parts


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def windows(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The last ORDER characters at each character of the normalised segments (column 0 the last; spaces before the
    first), and the segment of each."""
    lowered = [p.lower() + " " for p in parts]
    code = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), "<u4")
    part = np.repeat(np.arange(len(parts)), [len(p) for p in lowered])
    letter = _letters()[code]
    keep = letter.copy()
    keep[1:] |= letter[:-1] & (part[1:] == part[:-1])  # the first non-letter after a letter is the space
    code, part = np.where(letter, code, 32)[keep].astype(np.uint32), part[keep]
    if not len(code):
        return np.zeros((0, ORDER), np.uint32), part
    start = np.searchsorted(part, part)  # of the segment
    place = np.arange(len(code)) - start
    out = np.full((len(code), ORDER), 32, np.uint32)
    for j in range(ORDER):
        out[j:, j] = np.where(place[j:] >= j, code[:len(code) - j], 32)
    return out, part


def hashes(window: np.ndarray, first: int, last: int) -> np.ndarray:
    """A hash of the characters in columns ``first`` to ``last`` - 1 of windows."""
    h = np.zeros(len(window), np.uint64)
    for j in range(first, last):
        h += (window[:, j].astype(np.uint64) + np.uint64(1)) * np.uint64(_POWERS[j - first])
    return h


def _seed(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "replace"), digest_size=8).digest(), "little"))


def slots(h: np.ndarray, seed: np.uint64 | np.ndarray, bits: int = SLOT_BITS) -> np.ndarray:
    return (_mix(h ^ seed) >> np.uint64(64 - bits)).astype(np.uint32)


def _strings(window: np.ndarray) -> list[str]:
    flat = np.ascontiguousarray(window[:, ::-1], "<u4").tobytes().decode("utf-32-le")
    return [flat[i:i + ORDER] for i in range(0, len(flat), ORDER)]


def count_ngrams(docs: DataFrame) -> DataFrame:
    """lang, part, gram (ORDER characters), n over all texts of ``docs`` (text: binary, lang, part: int)."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []

        def merged() -> pd.DataFrame:
            return pd.concat(held).groupby(["key", "of"], sort=False).agg(n=("n", "sum"), gram=("gram", "first")).reset_index()

        names: dict[tuple[str, int], int] = {}

        def out(counts: pd.DataFrame) -> pa.RecordBatch:
            of = list(names)
            return pa.RecordBatch.from_pydict({
                "lang": pa.array([of[i][0] for i in counts["of"]], pa.string()), "part": pa.array([of[i][1] for i in counts["of"]], pa.int32()),
                "gram": pa.array(counts["gram"].tolist(), pa.string()), "n": pa.array(counts["n"].to_numpy(), pa.int64())})

        rows = 0
        for b in batches:
            kinds = np.array([names.setdefault(k, len(names)) for k in zip(b.column("lang").to_pylist(), b.column("part").to_pylist())], int)
            for places, parts in grouped(_text(t) for t in b.column("text")):
                window, part = windows(parts)
                of = kinds[places][part]
                key = _mix(_mix(hashes(window, 0, ORDER)) + of.astype(np.uint64) * np.uint64(_FACTOR))
                code, unique = pd.factorize(key)
                if not len(unique):
                    continue
                first = np.empty(len(unique), np.int64)
                first[code[::-1]] = np.arange(len(code))[::-1]
                held.append(pd.DataFrame({"key": unique, "of": of[first], "n": np.bincount(code), "gram": _strings(window[first])}))
                rows += len(unique)
                if rows > KEPT:
                    held = [merged()]
                    rows = len(held[0])
                    if rows > KEPT // 2:  # many kinds: handed on, to be added up after the exchange
                        yield out(held[0])
                        held, rows = [], 0
        if held:
            yield out(merged())

    return docs.mapInArrow(apply, "lang string, part int, gram string, n long").groupBy("lang", "part", "gram").agg(F.sum("n").alias("n"))


def _text(value: pa.Scalar) -> str | None:
    raw = value.as_py()
    return None if raw is None else raw.decode("utf-8", "replace")


def _lookup(keys: np.ndarray, values: np.ndarray, slot: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros((len(slot), *values.shape[1:]))
    at = np.minimum(np.searchsorted(keys, slot), len(keys) - 1)
    found = values[at].astype(float)
    found[keys[at] != slot] = 0
    return found


@dataclass
class Model:
    """Per order: sorted slots of n-grams with their counts, and of contexts with their totals and kinds."""

    langs: list[str]
    discounts: np.ndarray = field(repr=False)       # language x order
    letters: int                                    # different characters
    grams: list[tuple[np.ndarray, np.ndarray]] = field(repr=False)
    contexts: list[tuple[np.ndarray, np.ndarray]] = field(repr=False)
    curve: tuple[float, float] = (0.0, 1.0)         # of the calibration: chance = logistic(a + b * log2(1 + evidence))
    usual: dict[str, tuple[float, float]] = field(default_factory=dict)  # cross-entropy of a language's texts, and how far off it may be

    def bits(self, window: np.ndarray) -> np.ndarray:
        """- log2 of the probability of the last character of each window, by language."""
        out = np.empty((len(window), len(self.langs)), np.float32)
        gram = [hashes(window, 0, k) for k in range(1, ORDER + 1)]
        context = [hashes(window, 1, k) for k in range(1, ORDER + 1)]
        for i, lang in enumerate(self.langs):
            p = np.full(len(window), 1 / (self.letters + 1))  # one place for characters never seen
            for k in range(ORDER):
                n = _lookup(*self.grams[k], slots(gram[k], _seed(lang)))
                total, kinds = _lookup(*self.contexts[k], slots(context[k], _seed(lang))).T
                d, some = self.discounts[i, k], np.maximum(total, 1)
                p = np.where(total > 0, np.maximum(np.minimum(n, total) - d, 0) / some + np.minimum(d * kinds / some, 1) * p, p)
            out[:, i] = -np.log2(p)
        return out

    def entropies(self, texts: Iterator[str | None] | list[str | None], n_texts: int, known: dict) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropies (text x language) in bits a character, and the number of characters; ``known`` is kept between calls."""
        total, chars = np.zeros((n_texts, len(self.langs))), np.zeros(n_texts, np.int64)
        for places, parts in grouped(texts):
            window, part = windows(parts)
            if not len(window):
                continue
            code, unique = pd.factorize(hashes(window, 0, ORDER))
            first = np.empty(len(unique), np.int64)
            first[code[::-1]] = np.arange(len(code))[::-1]
            keys, bits = known.get("keys", np.zeros(0, np.uint64)), known.get("bits", np.zeros((0, len(self.langs)), np.float32))
            at = np.searchsorted(keys, unique)
            new = np.ones(len(unique), bool) if not len(keys) else keys[np.minimum(at, len(keys) - 1)] != unique
            if new.any():
                if len(keys) + new.sum() > KEPT:
                    keys, bits, new = keys[:0], bits[:0], np.ones(len(unique), bool)
                keys, bits = np.concatenate([keys, unique[new]]), np.concatenate([bits, self.bits(window[first[new]])])
                order = np.argsort(keys)
                known["keys"], known["bits"] = keys, bits = keys[order], bits[order]
                at = np.searchsorted(keys, unique)
            each = bits[at][code].astype(float)
            starts = np.nonzero(np.diff(part, prepend=-1))[0]
            of = np.array(places)[part[starts]]
            np.add.at(total, of, np.add.reduceat(each, starts))
            np.add.at(chars, of, np.diff(np.append(starts, len(part))))
        return total / np.maximum(chars, 1)[:, None], chars

    def answer(self, entropy: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place of the best language (the first on a tie), its cross-entropy, and the evidence in bits."""
        best = entropy.argmin(1)
        low = entropy[np.arange(len(entropy)), best]
        others = entropy.copy()
        others[np.arange(len(entropy)), best] = np.inf
        second = others.min(1)
        return best, low, np.where(np.isfinite(second), second - low, low) * chars


def _all_orders(grams: DataFrame) -> DataFrame:
    """lang, k, gram, n of all orders from lang, gram, n of the highest: below it n counts the characters before a gram."""
    orders = [stage(grams.select("lang", F.lit(ORDER).alias("k"), "gram", "n"), "langid-grams")]
    for k in range(ORDER - 1, 0, -1):
        lower = orders[-1].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        orders.append(stage(lower.select("lang", F.lit(k).alias("k"), "gram", "n"), "langid-grams"))
    return reduce(DataFrame.unionByName, orders)


def _slotted(df: DataFrame, bits: int) -> DataFrame:
    """lang, k, gram and counts to k, slot and counts, added up by slot; a gram of any length."""
    counts = [c for c in df.columns if c not in ("lang", "k", "gram")]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grams = b.column("gram").to_pylist()
            window = np.zeros((len(grams), ORDER), np.uint32)
            size = np.array([len(g) for g in grams], int)
            for n in range(1, ORDER + 1):
                rows = np.nonzero(size == n)[0]
                if len(rows):
                    code = np.frombuffer("".join(grams[i] for i in rows).encode("utf-32-le"), "<u4").reshape(-1, n)
                    window[rows, :n] = code[:, ::-1]
            h = np.zeros(len(grams), np.uint64)
            for n in range(1, ORDER + 1):
                h[size == n] = hashes(window[size == n], 0, n)
            seeds = np.array([_seed(x) for x in b.column("lang").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("k"), pa.array(slots(h, seeds, bits).astype(np.int64)), *[b.column(c) for c in counts]],
                                             names=["k", "slot", *counts])

    kinds = ", ".join(f"{c} long" for c in counts)
    return df.mapInArrow(apply, f"k int, slot long, {kinds}").groupBy("k", "slot").agg(*[F.sum(c).alias(c) for c in counts])


def estimate(grams: DataFrame, bits: int = SLOT_BITS) -> Model | None:
    """The Kneser-Ney model of n-gram counts (lang, gram, n); None where there are none."""
    every = _all_orders(grams)
    found = every.groupBy("lang", "k").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")).collect()
    if not found:
        return None
    langs = sorted({r.lang for r in found})
    discounts = np.full((len(langs), ORDER), 0.5)
    for r in found:
        if r.n1 and r.n2:
            discounts[langs.index(r.lang), r.k - 1] = min(max(r.n1 / (r.n1 + 2 * r.n2), 0.1), 0.9)
    letters = every.filter(F.col("k") == 1).select("gram").distinct().count()
    of = F.expr("substring(gram, 1, k - 1)")
    contexts = every.groupBy("lang", "k", of.alias("gram")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))

    def arrays(df: DataFrame, *columns: str) -> list[tuple[np.ndarray, np.ndarray]]:
        got = _slotted(df, bits).toPandas().sort_values(["k", "slot"])  # 2^bits rows an order at most
        out = []
        for k in range(1, ORDER + 1):
            rows = got[got["k"] == k]
            values = rows[list(columns)].to_numpy(np.float32)
            out.append((rows["slot"].to_numpy(np.uint32), values if len(columns) > 1 else values[:, 0]))
        return out

    return Model(langs, discounts, letters, arrays(every, "n"), arrays(contexts, "total", "kinds"))


def _curve(evidence: np.ndarray, right: np.ndarray, wrong: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Logistic regression on counts of right and wrong answers by evidence; its targets stay short of 0 and 1."""
    all_right, all_wrong = right.sum(), wrong.sum()
    high, low = (all_right + 1) / (all_right + 2), 1 / (all_wrong + 2)
    x = np.stack([np.ones_like(evidence), np.log2(1 + evidence)], 1)
    w = np.array([0.0, 0.1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        error = right * (high - p) + wrong * (low - p)
        hessian = (x * ((right + wrong) * p * (1 - p))[:, None]).T @ x + np.eye(2) * 1e-3
        step = np.linalg.solve(hessian, x.T @ error - 1e-3 * w)
        w = w + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), max(float(w[1]), 0.0)


def calibrate(model: Model, docs: DataFrame) -> Model:
    """``model`` with its curve and bounds of rejection, from ``docs`` (text: binary, lang) that it has not counted."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for b in batches:
            entropy, chars = model.entropies((_text(t) for t in b.column("text")), b.num_rows, known)
            best, low, evidence = model.answer(entropy, chars)
            some = chars > 0
            said = np.array(model.langs, object)[best]
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array(said[some], pa.string()), "is_right": pa.array((said == np.array(b.column("lang").to_pylist(), object))[some], pa.bool_()),
                "entropy": pa.array(low[some]), "evidence": pa.array(evidence[some]), "chars": pa.array(chars[some])})

    judged = stage(docs.mapInArrow(apply, "lang string, is_right boolean, entropy double, evidence double, chars long"), "langid-judged")
    bins = (judged.groupBy(F.round(F.log2(F.col("evidence") + 1), 1).alias("x"))
            .agg(F.count_if("is_right").alias("r"), F.count_if(~F.col("is_right")).alias("w")).toPandas())
    curve = _curve(2 ** bins["x"].to_numpy(float) - 1, bins["r"].to_numpy(float), bins["w"].to_numpy(float)) if len(bins) else model.curve
    mean = judged.filter("is_right").groupBy("lang").agg((F.sum(F.col("entropy") * F.col("chars")) / F.sum("chars")).alias("mean"))
    far = (F.col("entropy") - F.col("mean")) * F.sqrt("chars")  # what texts of few characters vary more by
    usual = judged.filter("is_right").join(mean, "lang").groupBy("lang").agg(
        F.max("mean").alias("mean"), F.percentile_approx(far, 1 - REJECTED, 10_000).alias("far")).collect()
    return Model(model.langs, model.discounts, model.letters, model.grams, model.contexts, curve, {r.lang: (r.mean, r.far) for r in usual})


def fit(docs: DataFrame, calibration: Column, bits: int = SLOT_BITS) -> Model | None:
    """The calibrated model of ``docs`` (text, lang); None where no text with a language has a letter.

    All rows are counted. The curve and the bounds come from a second model, which leaves
    out the rows where ``calibration`` is true, on those rows. Rows of null text or lang are
    not used. The driver and the tasks hold the model: 2^bits n-grams and contexts an order
    at most, so the number of n-grams that a corpus has does not bound it; languages are
    taken to be few.
    """
    rows = docs.select(F.col("text").cast("binary").alias("text"), "lang", F.coalesce(calibration, F.lit(False)).cast("int").alias("part"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = stage(count_ngrams(rows), "langid-counts")
    model = estimate(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), bits)
    apart = estimate(counts.filter("part = 0").select("lang", "gram", "n"), bits)
    if model and apart:
        judged = calibrate(apart, rows.filter("part = 1").select("text", "lang"))
        model.curve, model.usual = judged.curve, judged.usual
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """Add lang_pred, score (0 to 1), cross_entropy, rejected to ``docs`` (text); columns of these names are replaced.

    A text that is null or has no letter, and any text where ``model`` is None, is of
    language ``und``, score 0, null cross-entropy, rejected. Other texts always get the best
    learned language (the first by name on a tie), and ``rejected`` tells that even its
    cross-entropy is unusually high. A text of over SEGMENT characters is read to its end,
    in segments cut between words, each with spaces before it. Rows are neither moved nor
    dropped, repeated ones are answered alike, and an empty table gives no rows. Other
    columns, of any name but ``__made``, are kept.
    """
    made = ("lang_pred", "score", "cross_entropy", "rejected")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in made]
    if model is None:
        nothing = {"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0), "cross_entropy": F.lit(None).cast("double"), "rejected": F.lit(True)}
        return docs.select(*kept, *[c.alias(n) for n, c in nothing.items()])

    @F.arrow_udf("lang_pred string, score double, cross_entropy double, rejected boolean")
    def apply(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict = {}
        for texts in columns:
            entropy, chars = model.entropies((_text(t) for t in texts), len(texts), known)
            best, low, evidence = model.answer(entropy, chars)
            some = chars > 0
            a, b = model.curve
            score = np.where(some, 1 / (1 + np.exp(-np.clip(a + b * np.log2(1 + evidence), -30, 30))), 0.0)
            mean, far = (np.array([model.usual.get(x, (0.0, np.inf))[i] for x in model.langs])[best] for i in (0, 1))
            yield pa.StructArray.from_arrays([
                pa.array(np.where(some, np.array(model.langs, object)[best], UNDETERMINED), pa.string()), pa.array(score),
                pa.array(low, pa.float64(), mask=~some), pa.array(~some | ((low - mean) * np.sqrt(chars) > far))], names=list(made))

    return docs.withColumn("__made", apply(F.col("text").cast("binary"))).select(*kept, "__made.*")


def op12_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all ``documents``, learned from those that are not held out (crc32 of doc_id mod 5 is not 0).

    One in ten of the different texts learned from, by hash, calibrates.
    """
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out.alias("held_out"))
    model = fit(docs.filter(~F.col("held_out")).select("text", "lang"), F.pmod(F.xxhash64("text"), F.lit(10)) == 0)
    return predict(docs.select("doc_id", "text", "held_out"), model).drop("text")
