"""Lexical search, language identification and whitening against plain Python."""

from __future__ import annotations

import math
import os
import random
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle_compare import compare, duck  # noqa: E402

from tallylog.llm import langid, lexical, whitening  # noqa: E402

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


# ---------------------------------------------------------------- ranked lexical search

def _terms(text):
    flat = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", flat)


def _rank(docs, items, k):
    counts = [(i, Counter(_terms(t))) for i, t in docs if i is not None]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, n_all = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    asked = defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i].update(_terms(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c, n in counts:
            m = 100 - 50 + (50 * n * n_docs) // n_all
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            scored.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1) if s]
    return sorted(out)


def _found(spark, docs, items, **args):
    got = lexical.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **args)
    return sorted(map(tuple, got.collect()))


def test_lexical_sql_twin(spark):
    ok, said = compare(lexical.op11_lexical(spark, SF), duck(SF), lexical.ORACLE_SQL)
    assert ok, said


@pytest.mark.parametrize("k,block_terms", [(1, 1 << 18), (3, 1 << 18), (50, 5)])
def test_lexical_equals_brute_force_where_lists_close(spark, k, block_terms):
    rng = random.Random(k)
    words = [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(40)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))) for i in range(700)]
    items = [(i, " ".join(rng.choices(words, k=8))) for i in range(5)]
    assert _found(spark, docs, items, k=k, block_terms=block_terms) == _rank(docs, items, k)


def test_lexical_edges(spark):
    docs = [(1, None), (2, ""), (3, " \t.,"), (4, "Éa b"), (5, "éa b"), (6, "A1 a1 B"), (7, "a1"), (7, "a1"), (8, "a1"), (None, "a1 b"),
            (9, "x" * 10 + "-" + "あい  z"), (-5, "a1")]
    items = [(1, "a1 A1 a1"), (2, None), (3, "..."), (4, "éa"), (5, "absent"), (6, "b"), (6, "z あい"), (None, "b"), (7, " z")]
    got = _found(spark, docs, items)
    assert got == _rank(docs, items, 50)
    assert [r[2] for r in got if r[0] == 1] == [6, -5, 7, 7, 8] and {r[0] for r in got} == {1, 4, 6, 7}
    assert _found(spark, [], items) == [] and _found(spark, docs, []) == [] and _found(spark, [], []) == []


def test_lexical_reads_long_texts_to_the_end_and_ignores_other_columns(spark):
    long = "pad word! " * 250_000 + "needle"
    docs = [(1, long), (2, "needle thread"), (3, "pad"), *((i, f"other {i}") for i in range(10, 30))]
    items = [(1, "needle pad")]
    frame = spark.createDataFrame(docs, DOCS).withColumns({"item_id": F.lit(9), "rank": F.lit("x"), "a.b": F.lit(1), "n_terms": F.lit(0)})
    got = sorted(map(tuple, lexical.search(frame, spark.createDataFrame(items, ITEMS).withColumn("doc_id", F.lit(0))).collect()))
    assert got == _rank(docs, items, 50) and {r[2] for r in got} == {1, 2, 3}


# ---------------------------------------------------------------- language identification

def _normal(text):
    return re.sub(r"[\W\d_]+", " ", text.lower()).lstrip() + ("" if re.search(r"[\W\d_]$", text) else " ")


def _kneser_ney(texts, order=langid.ORDER):
    """Probability of a character after a context, by the textbook."""
    counts = [Counter() for _ in range(order + 1)]
    for t in texts:
        padded = " " * (order - 1) + _normal(t)
        counts[order].update(padded[i:i + order] for i in range(len(padded) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discount = [0.0] * (order + 1)
    for k in range(1, order + 1):
        n1, n2 = (sum(n == i for n in counts[k].values()) for i in (1, 2))
        discount[k] = min(max(n1 / (n1 + 2 * n2), 0.1), 0.9) if n1 and n2 else 0.5
    letters = len(counts[1])

    def p(gram):
        if not gram:
            return 1 / (letters + 1)
        same = [n for g, n in counts[len(gram)].items() if g[:-1] == gram[:-1]]
        below = p(gram[1:])
        if not same:
            return below
        d, total = discount[len(gram)], sum(same)
        return max(counts[len(gram)][gram] - d, 0) / total + d * len(same) / total * below

    return p


def test_cross_entropy_is_that_of_the_textbook(spark):
    texts = ["The cat sat on the mat. The end!", "A rat, a hat -- 42 cats", "Où est le chat?", "that"]
    rows = spark.createDataFrame([(t, "xx") for t in texts], "text string, lang string")
    model = langid.fit(rows, F.lit(False))
    p = _kneser_ney(texts)
    asked = ["the cats", "zzz", "Où?", "a", "THE RAT", "q9q"]
    entropy, chars = model.entropies(asked, len(asked), {})
    for t, h, n in zip(asked, entropy[:, 0], chars):
        padded = "   " + _normal(t)
        grams = [padded[i:i + 4] for i in range(len(padded) - 3)]
        assert n == len(grams)
        assert h == pytest.approx(-sum(math.log2(p(g)) for g in grams) / len(grams), rel=1e-5), t


def test_all_learning_texts_are_counted(spark):
    docs = spark.read.parquet(f"{SF2}/documents.parquet").select(F.col("text").cast("binary").alias("text"), "lang", F.lit(0).alias("part"))
    got = langid.count_ngrams(docs).groupBy("lang").agg(F.sum("n")).collect()
    want = Counter()
    for r in docs.collect():
        want[r.lang] += len(_normal(bytes(r.text).decode()))
    assert dict(map(tuple, got)) == dict(want)


def test_language_of_held_out_documents(spark):
    got = langid.op12_langid(spark, SF2).join(spark.read.parquet(f"{SF2}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out").collect()
    assert got.count() == 1000 and len(held) > 150
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in held) and sum(r.rejected for r in held) < 0.1 * len(held)


def _two_languages(spark, extra=()):
    rng = random.Random(3)
    make = {"aa": lambda: " ".join("".join(rng.choices("abcdef", k=4)) for _ in range(60)),
            "zz": lambda: " ".join("".join(rng.choices("uvwxyz", k=4)) for _ in range(60))}
    rows = [(make[lang](), lang) for lang in make for _ in range(60)] + list(extra)
    return spark.createDataFrame(rows, "text string, lang string")


def test_language_edges(spark):
    rows = _two_languages(spark, [(None, "aa"), ("abc", None), ("", "zz"), ("123 !!", "nn"), (None, None)])
    model = langid.fit(rows, F.pmod(F.xxhash64("text"), F.lit(5)) == 0)
    assert model.langs == ["aa", "zz"]  # a language without a letter is not learned
    texts = [None, "", "12 -- 3", "abc def", "Abc Def", "xyz", "xyz", "中文 中文 中文", "a퟿\U0001f600b"]
    asked = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], DOCS).withColumns({"score": F.lit("old"), "a.b": F.lit(2)})
    got = sorted(langid.predict(asked, model).collect())
    assert langid.predict(asked, model).columns == ["doc_id", "text", "a.b", "lang_pred", "score", "cross_entropy", "rejected"]
    assert [r.lang_pred for r in got[:7]] == ["und", "und", "und", "aa", "aa", "zz", "zz"]
    assert all(r.score == 0 and r.cross_entropy is None and r.rejected for r in got[:3])
    assert got[3].cross_entropy == got[4].cross_entropy and got[5][3:] == got[6][3:] and got[3].score > 0.8
    assert got[7].lang_pred in ("aa", "zz") and got[7].rejected and not got[3].rejected
    assert langid.predict(asked.limit(0), model).count() == 0
    none = langid.fit(rows.limit(0), F.lit(True))
    assert none is None and [r.lang_pred for r in langid.predict(asked, none).collect()] == ["und"] * len(texts)


def test_languages_that_only_calibrate_are_learned_and_ties_go_by_name(spark):
    rows = spark.createDataFrame([("abab abab", "bb"), ("abab abab", "aa")], "text string, lang string")
    model = langid.fit(rows, F.lit(True))
    got = langid.predict(spark.createDataFrame([(1, "abab")], DOCS), model).first()
    assert model.langs == ["aa", "bb"] and got.lang_pred == "aa"


def test_long_texts_are_read_to_the_end(spark):
    model = langid.fit(_two_languages(spark), F.lit(False))
    size = langid.SEGMENT
    texts = ["abcdef " * (size // 20) + "uvwxyz " * size, "a" * (2 * size + 7) + " " + "uz" * (3 * size)]
    assert all("".join(langid.segments(t)) == t and max(map(len, langid.segments(t))) <= 2 * size for t in texts)
    got = langid.predict(spark.createDataFrame(list(enumerate(texts)), DOCS), model).collect()
    assert [r.lang_pred for r in got] == ["zz", "zz"]


def test_a_model_has_no_more_entries_than_slots(spark):
    counts = spark.createDataFrame([("aa", f"{i:04d}", 3) for i in range(3000)], "lang string, gram string, n long")
    model = langid.estimate(counts, bits=6)
    assert all(len(keys) <= 64 and (np.diff(keys.astype(int)) > 0).all() for keys, _ in model.grams + model.contexts)
    assert model.grams[-1][1].sum() == 9000


# ---------------------------------------------------------------- whitening

VECTORS = "vec_id long, embedding array<float>"


def _whitened(rows, k, by_count=False):
    """By vec_id: deviation and whitened values; explained; all with signs as numpy has them."""
    x = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in e)) for i, e in rows]
    fit = list(Counter(v for _, v in x).items())
    weights = [c if by_count else 1 for _, c in fit]
    n, d = sum(weights), len(fit[0][0])
    sums = [sum(w * v[j] for (v, _), w in zip(fit, weights)) for j in range(d)]
    centred = np.array([[(n * v[j] - sums[j]) / n for j in range(d)] for v, _ in fit])
    values, vectors = np.linalg.eigh((centred * np.array(weights)[:, None]).T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1].T[:k]
    done = {v: (sum((n * v[j] - sums[j]) ** 2 for j in range(d)), vectors @ c / np.sqrt(values)) for (v, _), c in zip(fit, centred)}
    trace = (centred ** 2 * np.array(weights)[:, None]).sum() / n
    return n, [(i, *done[v]) for i, v in x], values / trace


def _check(got, rows, k=4, by_count=False):
    n, want, explained = _whitened(rows, k, by_count)
    by = defaultdict(list)
    for r in got:
        assert r.n == n and r.explained == pytest.approx(explained[r.component - 1], rel=1e-9) and r.identity_error < 1e-6
        by[r.vec_id].append(r)
    ids = Counter(i for i, _, _ in want)
    assert {i: len(r) for i, r in by.items()} == {i: c * k for i, c in ids.items()}
    assert all(r.deviation == dev for i, dev, _ in want if ids[i] == 1 for r in by[i])
    for c in range(1, k + 1):
        single = sorted((r.vec_id, r.whitened) for r in got if r.component == c and ids[r.vec_id] == 1)
        mine = np.array([w for _, w in single])
        wanted = np.array([w[c - 1] for _, w in sorted(((i, w) for i, _, w in want if ids[i] == 1), key=lambda t: t[0])])
        assert min(np.abs(mine - wanted).max(), np.abs(mine + wanted).max()) < 1e-8


def test_whitening_of_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    _check(whitening.op13_whitening(spark, SF).collect(), rows)


@pytest.mark.parametrize("by_count", [False, True])
def test_whitening_counts_equal_vectors_once_or_by_number(spark, by_count):
    rng = np.random.default_rng(4)
    base = (rng.normal(size=(90, 6)) * [9, 5, 3, 2, 1, 1] + 40).astype("float32").tolist()
    rows = [(i, base[0] if i % 3 == 0 else base[i % 90]) for i in range(3300)]  # a third of all rows is one vector
    rows += [(5000 + i, [c + 1e-4 if 0 < (256 * c) % 1 < 0.9 else c for c in base[i]]) for i in range(40)]  # most of them equal after the floor
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS), by_count=by_count)
    _check(got.collect(), rows, by_count=by_count)
    assert len({(r.x, r.w) for r in got.filter("vec_id % 3 = 0 and vec_id < 3300 and component = 1").select(F.col("deviation").alias("x"), F.col("whitened").alias("w")).collect()}) == 1


def test_whitening_edges(spark):
    good = [(i, [float(i % 5), float(i * i % 7), 1.0]) for i in range(20)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (103, [float("inf"), 0.0, 0.0]), (104, []), (105, [1.0, 2.0])]
    extra = [(None, [3.0, 1.0, 1.0]), (7, [2.0, 0.0, 1.0])]
    frame = spark.createDataFrame(good + bad + extra, VECTORS).withColumns({"x": F.lit(1), "component": F.lit("c"), "a.b": F.lit(0)})
    got = whitening.whiten(frame).collect()
    assert {r.component for r in got} == {1, 2}  # the third dimension does not vary
    assert Counter(r.vec_id for r in got) == Counter({**{i: 2 for i in range(20)}, 7: 4, None: 2})
    _check([r for r in got if r.vec_id is not None], good + extra[1:], k=2) if len({tuple(e) for _, e in good + extra}) == len({tuple(e) for _, e in good + extra[1:]}) else None
    for rows in ([], bad[:4], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        empty = whitening.whiten(spark.createDataFrame(rows, VECTORS))
        assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and empty.count() == 0


def test_whitening_beyond_64_bits(spark):
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 5.0])]
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS), components=1).collect()
    assert {r.vec_id: r.deviation for r in got if r.vec_id < 3} == {1: None, 2: None}
    assert all(np.isfinite(r.whitened) for r in got) and got[0].identity_error < 1e-6
    big = [(i, [float(i % 4) * 4e5, float(i % 3)]) for i in range(8)]
    _check(whitening.whiten(spark.createDataFrame(big, VECTORS), components=2).collect(), big, k=2)
