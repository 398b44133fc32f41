"""The corpus pipeline against plain Python, stage by stage, and the edges and sizes of some operators."""

from __future__ import annotations

import os
import sys

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE), os.path.dirname(os.path.dirname(HERE))]
from oracle_compare import compare, duck  # noqa: E402
from test_pii_twin import _twin  # noqa: E402
from test_table_operators import _components, _fingerprint  # noqa: E402

import corpus_pipeline  # noqa: E402
from tallylog.llm import bpe, mixing, neighbours, quality, sharding, simhash, toxicity  # noqa: E402

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.vocabulary_path())


def _kept(spark, docs, rows):
    model = quality.fit(docs)  # scored here without Spark
    return [r for r in rows if model.score(r["text"])[0] >= quality.THRESHOLD]


def _one_of_each(rows):
    first = {}
    rows = sorted(rows, key=lambda r: r["doc_id"])
    for r, c in zip(rows, _components([_fingerprint(r["text"]) for r in rows])):
        first.setdefault(c, r)
    ids = {r["doc_id"] for r in first.values()}
    return [r for r in rows if r["doc_id"] in ids]


def _private(rows):
    new = _twin([(r["doc_id"], r["text"]) for r in rows])
    return [{**r, "text": new[r["doc_id"]][0], "n_chars": len(new[r["doc_id"]][0]) if new[r["doc_id"]][1] else r["n_chars"]} for r in rows]


def _mixed(rows):
    con = duckdb.connect()
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"])
    for c in ("text", "lang", "source"):
        frame[c] = frame[c].astype(object).where(frame[c].notna(), None)
    con.register("documents", frame.astype({"text": "string", "lang": "string", "source": "string"}))
    sql = mixing.ORACLE_SQL.replace("* 500 // 1000", f"* {int(corpus_pipeline.MIX_SHARE * 1000)} // 1000").replace(
        "sum(tokens) * 2", f"sum(tokens) * {corpus_pipeline.MIX_EPOCHS}")
    ids = {r[0] for r in con.execute(f"SELECT doc_id FROM ({sql})").fetchall()}
    return [r for r in rows if r["doc_id"] in ids]


def _key(r):
    return r["doc_id"], r["text"] or "", str(r["lang"]), str(r["source"]), r["n_chars"] or -1


def _collected(df):
    return sorted((r.asDict() for r in df.collect()), key=_key)


def _run_and_compare(spark, docs, library):
    """Each stage on what its own predecessor kept, against the twin of the stage; the last rows."""
    for (_, apply), twin in zip(corpus_pipeline.STAGES[:-1], (lambda rows: _kept(spark, docs, rows), _one_of_each, _private, _mixed)):
        before = _collected(docs.select(*corpus_pipeline.COLUMNS))
        after, want = apply(spark, docs, SF), twin(before)
        assert after.columns == corpus_pipeline.COLUMNS
        docs = corpus_pipeline.stage(after, "test-stage")
        assert _collected(docs) == sorted(want, key=_key), apply.__name__
    rows = {r["doc_id"]: r for r in _collected(docs)}
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(rows)
    for r in got:
        ids = library.encode(rows[r.doc_id]["text"] or "", add_special_tokens=False).ids
        assert (r.lang, r.source, r.n_tokens) == (rows[r.doc_id]["lang"], rows[r.doc_id]["source"], len(ids))
        assert np.frombuffer(r.token_ids, "<u4").tolist() == ids
    return got


def test_pipeline_on_the_table(spark, library):
    stages = _run_and_compare(spark, spark.read.parquet(f"{SF}/documents.parquet"), library)
    assert len(stages) > 50
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages))


def test_pipeline_on_nulls_repeats_and_odd_texts(spark, library, new_dir):
    good = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'en'").limit(40).collect()]
    odd = [(900, None, "en", "src1", None), (901, "", "en", None, 0), (902, " \n\t ", None, "src2", 4), (903, "!!! $$$ ### | | |", "fr", "x", 17),
           (904, "Mr. John Smith wrote to a@b.com.", None, None, 32), (905, "Mr. John Smith wrote to a@b.com.", "de", "src9", 32),
           (906, good[0]["text"], "en", "src1", good[0]["n_chars"]), (907, "漢字 かな 漢字", "ja", "src0", 8)]
    docs = spark.createDataFrame([tuple(r[c] for c in corpus_pipeline.COLUMNS) for r in good] + odd, SCHEMA)
    _run_and_compare(spark, docs.withColumns({"a.b": F.lit(1), "fp": F.lit("x"), "tokens": F.lit("y")}), library)
    folder = new_dir("sf")
    rows = docs.unionByName(docs.limit(3)).unionByName(spark.createDataFrame([(None, "no id at all, but a text", "en", "src1", 24), (None, None, None, None, None)], SCHEMA))
    rows.write.parquet(f"{folder}/documents.parquet")  # repeated rows and null ids pass through, none more often than it came
    got = [r.doc_id for r in corpus_pipeline.run(spark, folder).collect()]
    assert len(got) == len(set(got)) and set(got) <= {r.doc_id for r in rows.collect()}


def test_pipeline_on_an_empty_table(spark, new_dir):
    folder = new_dir("empty")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.run(spark, folder)
    assert out.count() == 0 and out.columns == ["doc_id", "lang", "source", "n_tokens", "token_ids"]


# ---------------------------------------------------------------- sizes and edges

def test_neighbours_sql_twin(spark):
    from tallylog.llm import catalog
    ok, said = compare(catalog.QUERIES["op5_neighbours"](spark, SF), duck(SF), catalog.ORACLE_SQL["op5_neighbours"])
    assert ok, said


def test_neighbours_of_copied_rows_and_unlike_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 64)
    monkeypatch.setattr(neighbours, "COPIES", 16)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(150)] + [(500, [3.0, 3.0, 3.0, 3.0])] * 300 + [(501, [3.0, 3.0, 3.0, 3.0])] * 3
    odd = [(600, [1.0, 2.0]), (601, [1e200, 1.0, 0.0, 0.0]), (602, [1e200, 2.0, 0.0, 0.0])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    asked = frame.filter("vec_id % 20 = 0 or vec_id > 500")
    got = {}
    for r in neighbours.search(frame, asked, k=5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    x = np.array([v for _, v in rows])
    ids = np.array([i for i, _ in rows])
    want = {}
    for q in sorted({i for i in ids.tolist() if i % 20 == 0 or i > 500}):
        score = x @ x[np.nonzero(ids == q)[0][0]]
        order = [j for j in np.lexsort((ids, -np.round(score, 9))) if ids[j] != q][:5]
        want[q] = [int(ids[j]) for j in order]
    assert {q: [v for _, v, _ in sorted(r)] for q, r in got.items()} == want


def test_intervals_follow_from_the_rows(spark, monkeypatch):
    seen = []
    interval = sharding._interval
    monkeypatch.setattr(sharding, "_interval", lambda bounds: seen.append(len(bounds)) or interval(bounds))
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), (F.col("id") % 37 + 1).alias("size"))
    few = sharding.shard_by_bytes(rows, "doc_id", F.col("size"), shards=4, least_intervals=2).collect()
    n_few, _ = max(seen), seen.clear()
    many = sharding.shard_by_bytes(rows, "doc_id", F.col("size"), shards=4, interval_rows=20, least_intervals=2).collect()
    assert max(seen) >= 300 > 10 * n_few / 4
    total = sum(r.size for r in many)
    for got in (few, many):
        by = {s: [r for r in got if r.shard == s] for s in range(4)}
        assert all(abs(sum(r.size for r in b) - total / 4) <= 37 + 0.001 * total for b in by.values())
        assert all(sorted(r.slot for r in b) == list(range(len(b))) for b in by.values())
    assert sum(a.shard != b.shard for a, b in zip(sorted(few), sorted(many))) <= 30  # a few at the boundaries


def test_ranges_follow_from_the_rows(spark, monkeypatch):
    assert [mixing.range_digits(n) for n in (0, 1, 16 * 4096, 16 * 4096 + 1, 10**9, 10**12)] == [1, 1, 1, 2, 5, 7]
    want = sorted(map(tuple, mixing.op8_mixing(spark, SF).collect()))
    for size in (1, 10**9):
        monkeypatch.setattr(mixing, "RANGE_ROWS", size)
        assert sorted(map(tuple, mixing.op8_mixing(spark, SF).collect())) == want


def test_names_with_dots_are_kept(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, "one two three"), (3, "four")], "doc_id long, text string").withColumn("a.b", F.lit(5))
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == [1, 3]


def test_toxicity_fit_drops_equal_features_only(spark, monkeypatch):
    rows = []
    monkeypatch.setattr(toxicity, "fit_ordinal", lambda r, grades, n: rows.extend(r))
    common = " ".join(f"w{i}" for i in range(40))
    texts = [common + " alpha", common + " beta", common + " beta", common + " gamma delta"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0) for i in range(4)], "doc_id long, toxic int")
    toxicity.fit(docs, labels)
    assert len(rows) == 3


def test_toxicity_equals_a_fit_and_scores_without_spark(spark):
    docs = spark.read.parquet(f"{SF2}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF2}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    label = {}
    for r in labels.collect():
        if r.doc_id is not None and r.toxic is not None:
            label[r.doc_id] = max(label.get(r.doc_id, 0), int(r.toxic))
    once = {}
    for i in sorted(i for i in label if i in texts):
        once.setdefault((toxicity.text_places(texts[i]).tobytes(), label[i] > 0), i)
    rows = [np.frombuffer(places, np.int32) for places, _ in once]
    toxic = np.array([int(y) for _, y in once])
    model = toxicity.fit_ordinal(rows, toxicity.severity_grades(rows, toxic), 3)
    assert 3 < len(label) <= toxicity.TRAINING_ROWS
    for r in toxicity.op4_toxicity(spark, SF2).collect():
        p = model.grades(toxicity.text_places(texts[r.doc_id]))
        assert r.severity == int(p.argmax()) and r.expected_severity == pytest.approx(float(p @ np.arange(3)), abs=1e-6), r.doc_id


@pytest.mark.parametrize("shape", ["even", "unlike norms", "low rank"])
def test_the_chosen_factor_keeps_its_recall(spark, shape, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 700)
    rng = np.random.default_rng(12)
    x = rng.normal(size=(2500, 24))
    if shape == "low rank":
        x = rng.normal(size=(2500, 5)) @ rng.normal(size=(5, 24))
    if shape == "unlike norms":
        x = (rng.normal(size=(30, 24))[rng.integers(0, 30, 2500)] + 0.1 * x) * rng.lognormal(0, 1, 2500)[:, None]
    else:
        x /= np.linalg.norm(x, axis=1)[:, None]
    frame = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    asked = frame.filter("vec_id % 10 = 0")
    index = neighbours.build(frame)
    factor = neighbours.choose_factor(index, asked, sample=60)
    assert factor in (*neighbours.FACTORS, 1.0) and index.trees.count() >= 3
    exact, found = neighbours.find(index, asked, factor=1.0), neighbours.find(index, asked, factor=factor)
    assert neighbours.recall(found, exact) >= 0.9
    score = x[::10] @ x.T
    score[np.arange(250), np.arange(0, 2500, 10)] = -np.inf
    want = {(10 * i, int(j)) for i, row in enumerate(np.argsort(-score, axis=1)[:, :20]) for j in row}
    assert {(r.query_id, r.vec_id) for r in exact.collect()} == want
