"""SimHash, neighbours, mixing, sharding and the classifiers against plain Python."""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle_compare import compare, duck  # noqa: E402

from tallylog.llm import licences, mixing, neighbours, quality, sharding, simhash, toxicity  # noqa: E402

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = "doc_id long, text string"


@pytest.mark.parametrize("name", ["op2_licences", "op8_mixing"])
def test_sql_twins(spark, name):
    from tallylog.llm import catalog
    ok, said = compare(catalog.QUERIES[name](spark, SF), duck(SF), catalog.ORACLE_SQL[name])
    assert ok, said


# ---------------------------------------------------------------- SimHash

def _fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    bits = Counter(b for s in shingles for h in [xxhash.xxh64_intdigest(s.encode(), 42)] for b in range(64) if h >> b & 1)
    return sum(1 << b for b, n in bits.items() if 2 * n > len(shingles))


def _components(fps, r=3):
    up = list(range(len(fps)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    a = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.nonzero(np.bitwise_count(a ^ a[i]) <= r)[0].tolist():
            x, y = sorted((root(i), root(j)))
            up[y] = x
    return [root(i) for i in range(len(fps))]


def test_fingerprints_of_texts(spark):
    texts = [None, "", " \t\n", "one", "One TWO", "É é Z z a b", "a b c a b c a b c", "x\x0by\x0cz w", "word " * 20000]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in simhash.simhash(spark.createDataFrame(rows, DOCS)).collect()}
    for i, t in rows:
        assert got[i].fingerprint == f"{_fingerprint(t):016x}", t
    assert got[0].component_id == got[1].component_id == got[2].component_id == 0


@pytest.mark.parametrize("block", [40, 100_000])
def test_components_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "LEAF", 4)
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 2**64, 120, np.uint64).tolist() + [0, 1, 2**64 - 1]
    for i in range(150):  # chains: each some bits from an earlier one
        fps.append(fps[int(rng.integers(len(fps)))] ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 6)), False)))
    fps += fps[:30]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    rows = [(None if i % 50 == 7 else 1000 - i, f) for i, f in enumerate(signed)]
    found = {r.fp: r.component_id for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, fp long")).collect()}
    roots = _components(fps)
    least = {}
    for (doc_id, _), root in zip(rows, roots):
        if doc_id is not None:
            least[root] = min(doc_id, least.get(root, doc_id))
    assert [found[f] for f in signed] == [least.get(r) for r in roots]


def test_one_document_of_each_component_stays(spark):
    text = "some words that make a text of their own " * 4
    rows = [(5, text, "a"), (3, text, "b"), (3, text, "b"), (9, "quite another text with other words", "c"), (None, None, "d"), (None, "", "e")]
    docs = spark.createDataFrame(rows, DOCS + ", fp string")
    kept = sorted((r.doc_id or 0, r.text or "") for r in simhash.keep_one(docs).collect())
    assert kept == [(0, ""), (3, text), (9, rows[3][1])]
    assert simhash.keep_one(docs).columns == docs.columns
    assert simhash.keep_one(docs.limit(0)).count() == 0 and simhash.simhash(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- neighbours

def _brute(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for q in queries:
        s = np.einsum("nd,d->n", x, x[ids == q][0])
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(s[i])) for i in order]
    return out


@pytest.mark.parametrize("shard", [30, 10_000])
def test_neighbours_are_exact_at_factor_one(spark, shard, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", shard)
    monkeypatch.setattr(neighbours, "LEAF", 4)
    monkeypatch.setattr(neighbours, "QUERIES", 7)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.3 * rng.normal(size=8)).astype("float32").tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(60)]  # copies: ties
    bad = [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] * 8), (1060, [float("inf")] + [1.0] * 7), (1080, [None] + [1.0] * 7), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").repartition(3)
    got = {}
    for r in neighbours.search(df, df.filter("vec_id % 20 = 0"), 20, 1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = _brute(rows, [i for i, _ in rows if i % 20 == 0], 20)
    assert {q: [v for v, _ in x] for q, x in got.items()} == {q: [v for v, _ in x] for q, x in want.items()}
    assert all(abs(a[1] - b[1]) < 1e-12 for q in want for a, b in zip(got[q], want[q]))


def test_neighbours_recall_and_edges(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = _brute(rows, [i for i, _ in rows if i % 20 == 0], 20)
    got = {}
    for r in neighbours.op5_neighbours(spark, SF).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall = np.mean([len({v for v, _ in want[q]} & got[q]) / 20 for q in want])
    assert recall >= 0.9
    assert neighbours.search(df.limit(0), df.limit(0)).count() == 0
    three = df.filter("vec_id < 3")
    assert neighbours.search(three, three).count() == 6  # fewer candidates than asked for


@pytest.mark.parametrize("shape", ["unlike norms", "low rank"])
def test_neighbours_recall_on_vectors_that_prune(spark, shape, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 1000)
    rng = np.random.default_rng(11)
    if shape == "low rank":
        x = rng.normal(size=(3000, 6)) @ rng.normal(size=(6, 32))
        x /= np.linalg.norm(x, axis=1)[:, None]
    else:
        x = rng.normal(size=(40, 32))[rng.integers(0, 40, 3000)] + 0.1 * rng.normal(size=(3000, 32))
        x *= rng.lognormal(0, 1, 3000)[:, None]
    rows = list(enumerate(x.tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = _brute(rows, range(0, 3000, 60), 20)
    got = {}
    for r in neighbours.search(df, df.filter("vec_id % 60 = 0"), 20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len({v for v, _ in want[q]} & got.get(q, set())) / 20 for q in want]) >= 0.9


# ---------------------------------------------------------------- mixing

def _fill(amount, children):
    got, open_ = {}, dict(children)
    while open_:
        total = sum(w for w, _ in open_.values())
        full = {c for c, (w, cap) in open_.items() if cap * total <= amount * w}
        if not full:
            return got | {c: amount * w // total for c, (w, _) in open_.items()}
        first = min(full, key=lambda c: (open_[c][1] / open_[c][0], c))
        got[first] = open_[first][1]
        amount -= open_.pop(first)[1]
    return got


def test_budgets_redistribute_among_siblings_first(spark):
    leaves = [("web", "en", "a", 100), ("web", "en", "b", 10), ("web", "fr", "c", 5), ("books", "en", "d", 1000), ("books", "de", "e", 0)]
    weights = {"domain": {"web": 3}, "lang": {"en": 2}, "source": {"b": 4}}
    got = {r.source: r for r in mixing.leaf_budgets(
        spark.createDataFrame(leaves, "domain string, lang string, source string, supply long"), weights, 0.2, 2).collect()}
    domains = _fill(int(1115 * 0.2), {"web": (3, 230), "books": (1, 2000)})
    langs = _fill(domains["web"], {"en": (2, 220), "fr": (1, 10)})
    want = _fill(langs["en"], {"a": (1, 200), "b": (4, 20)}) | {"c": langs["fr"], "e": 0, "d": _fill(domains["books"], {"en": (2, 2000), "de": (1, 0)})["en"]}
    assert {s: r.budget for s, r in got.items()} == want
    assert got["b"].budget == 20 and got["b"].whole_epochs == 2  # full: its siblings took the rest


def test_mix_edges(spark):
    rows = [(1, "a b c", "en", "src0", 1), (1, "a b c", "en", "src0", 1), (None, "x", None, None, 2), (3, None, "en", "src1", 3), (4, "", "de", "src2", 4)]
    docs = spark.createDataFrame(rows, DOCS + ", lang string, source string, tokens int")
    whole = mixing.mix(docs, share=1.0, max_epochs=1)
    assert sorted((r.doc_id or 0, r.tokens) for r in whole.collect()) == [(0, 1), (1, 3), (1, 3)]
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs, share=0.0).count() == 0


# ---------------------------------------------------------------- sharding

@pytest.mark.parametrize("ids", ["plain", "hot", "wide"])
def test_shards_are_even_and_slots_gapless(spark, ids):
    rng = np.random.default_rng(4)
    n = 3000
    keys = {"plain": list(range(n)), "hot": [7] * n, "wide": [int(x) for x in rng.integers(-2**62, 2**62, n)]}[ids]
    sizes = [int(x) for x in np.where(rng.random(n) < 0.01, 4000, rng.integers(1, 50, n))]
    rows = [(None if i == 5 else k, s, "x") for i, (k, s) in enumerate(zip(keys, sizes))]
    df = spark.createDataFrame(rows, "doc_id long, size long, shard string").repartition(5)
    got = sharding.shard_by_bytes(df, "doc_id", F.col("size")).collect()
    assert sorted((r.doc_id or 0, r.size) for r in got) == sorted((k or 0, s) for k, s, _ in rows)
    total, largest = sum(sizes), max(sizes)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    assert sorted(by) == list(range(8))
    for s in range(8):
        assert abs(sum(r.size for r in by[s]) - total / 8) <= largest + 0.001 * total
        assert sorted(r.slot for r in by[s]) == list(range(len(by[s])))
        keys_ = [r.doc_id if r.doc_id is not None else -2**63 for r in sorted(by[s], key=lambda r: r.slot)]
        assert keys_ == sorted(keys_)


def test_sharding_query_and_edges(spark):
    import zlib
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = sharding.op10_sharding(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        data = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
    one = spark.createDataFrame([(1, None)], "k long, size long")
    assert [(r.shard, r.slot) for r in sharding.shard_by_bytes(one, "k", F.col("size")).collect()][0][1] == 0
    assert sharding.shard_by_bytes(one.limit(0), "k", F.col("size")).count() == 0


# ---------------------------------------------------------------- classifiers

def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    got = {r.doc_id: r.keep for r in quality.op9_quality(spark, SF2).collect()}
    assert len(got) == docs.count()
    labels = spark.read.parquet(f"{SF2}/labels.parquet").collect()  # never seen by the fit
    right = sum(got[r.doc_id] == bool(r.quality) for r in labels)
    assert right / len(labels) > 0.97
    assert sum(not got[r.doc_id] for r in labels if r.quality) <= 0.01 * len(labels)


def test_vote_model_finds_the_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20000) < 0.7
    accuracy = np.linspace(0.6, 0.95, quality.LABELLERS)
    patterns = np.zeros(len(truth), np.int64)
    for i, a in enumerate(accuracy):
        vote = np.where(rng.random(len(truth)) < a, truth, ~truth).astype(int)
        vote[rng.random(len(truth)) < 0.3] = quality.ABSTAIN
        patterns += vote * 3**i
    unique, counts = np.unique(patterns, return_counts=True)
    model = quality.estimate(unique, counts.astype(float))
    assert abs(model.good - 0.7) < 0.02 and np.abs(model.right - accuracy).max() < 0.03
    assert ((model.posterior(patterns) > 0.5) == truth).mean() > 0.97


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, True), (2, "", True), (None, "Plain words, in a row.", False), (3, "!! " * 9000, False)], DOCS + ", keep boolean")
    out = quality.classify(docs, quality.fit(docs))
    assert out.columns == ["doc_id", "text", "quality_score", "label_posterior", "keep"] and out.count() == 4
    assert quality.classify(docs.limit(0), quality.fit(docs.limit(0))).count() == 0


def test_toxicity_on_held_out_rows(spark):
    # fitted on labelled rows of one table, measured on the later half of them that the fit does not see
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.fit(docs, labels.filter("doc_id % 4 != 0"))
    held = labels.filter("doc_id % 4 = 0").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    rows = toxicity.grade(docs.join(held, "doc_id"), model).collect()
    assert sum(r.toxic == bool(r.label) for r in rows) / len(rows) > 0.95
    mean = {y: np.mean([r.expected_severity for r in rows if r.label == y]) for y in (0, 1)}
    assert mean[1] > mean[0] + 0.5


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(2)
    rows, grades = [], []
    for _ in range(1500):
        g = int(rng.integers(0, 4))
        rows.append(np.unique(np.concatenate([rng.choice(10, 3 * g, False) if g else [], 100 + rng.integers(0, 40, 5)]).astype(np.int32)))
        grades.append(g)
    model = toxicity.fit_ordinal(rows, np.array(grades), 4)
    expected = np.array([model.grades(r) @ np.arange(4) for r in rows])
    assert (np.diff(model.thresholds) > 0).all()
    assert np.abs(expected - grades).mean() < 0.3


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (None, "some words", 3)], DOCS + ", severity int")
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 1), (8, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    out = toxicity.grade(docs, model)
    assert out.columns == ["doc_id", "text", "expected_severity", "severity", "toxic_chance", "toxic"] and out.count() == 3
    assert toxicity.grade(docs.limit(0), toxicity.fit(docs.limit(0), labels.limit(0))).count() == 0
