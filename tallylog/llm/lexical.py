"""Ranked lexical search: accumulator-limited term-at-a-time evaluation.

1. Every document is cut into terms once. Of each, the number of its terms and the
   frequencies of those terms that the queries hold are written to the shared folder.
   From there come the statistics over all documents (N, L and the df of the terms).
2. A task takes the written documents in blocks. It turns a block into one list of
   postings a term, each with what it adds to a score, and the largest such addend.
3. For a query the lists are taken rarest term first, and addends are summed in one
   accumulator a document. Before each list, the largest addends of it and of those
   that follow are summed. Once that sum is below the k-th best score known (the k-th
   partial score of the block, or the k-th score of documents seen before), no document
   without an accumulator can be among the best, and no accumulators are made any more;
   those that there are go on to be updated, so their scores are exact.
4. A small share of the documents, by hash, is searched first. The k-th scores found
   there bound the search of all others, so that tasks return few rows.

The result is exact: equal bounds never close the lists, as a tie may go to a smaller doc_id.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallylog.llm.common import stage, table

K = 50
#: Queries are taken together until they hold so many terms; each such block reads the documents once.
BLOCK_TERMS = 1 << 18
#: One document in so many is searched first, for its bounds.
FIRST_OF = 32
#: Bytes of a text that are cut into terms at once.
PIECE = 1 << 20

# Terms are runs of ASCII letters and digits and of all that is not ASCII; only A-Z are lower-cased.
_FLAT = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()


def term_counts(text: bytes) -> Counter[bytes]:
    """How often each term occurs in a text (UTF-8)."""
    flat = text.translate(_FLAT)
    counts: Counter[bytes] = Counter()
    at = 0
    while at < len(flat):
        end = flat.find(b" ", at + PIECE)  # long texts piece by piece, cut between terms
        end = len(flat) if end < 0 else end
        counts.update(flat[at:end].split())
        at = end
    return counts


def _forward(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document with a term: doc_id, n_terms, and the places and frequencies of its terms in ``vocabulary``."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                counts = term_counts(text.as_py())
                if counts:
                    known = [(vocabulary[t], c) for t, c in counts.items() if t in vocabulary]
                    rows.append((doc_id, counts.total(), [t for t, _ in known], [c for _, c in known]))
            ids, n, places, freqs = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "n_terms": pa.array(n, pa.int64()),
                "places": pa.array(places, pa.list_(pa.int32())), "freqs": pa.array(freqs, pa.list_(pa.int32()))})

    return docs.mapInArrow(apply, "doc_id long, n_terms long, places array<int>, freqs array<int>")


class Block:
    """The postings of one block of documents, term by term."""

    def __init__(self, batch: pa.RecordBatch, weights: np.ndarray, n_docs: int, n_all: int):
        self.ids = batch.column("doc_id").to_numpy()
        n = batch.column("n_terms").to_numpy()
        places, freqs = batch.column("places"), batch.column("freqs")
        tf = freqs.flatten().to_numpy().astype(np.int64)
        term = places.flatten().to_numpy()
        whole, part = divmod(50 * n_docs, n_all)  # (50 * n * N) div L, without the large product
        m = 50 + n * whole + n * part // n_all
        doc = np.repeat(np.arange(len(self.ids)), places.value_lengths().to_numpy())
        addend = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
        by_term = np.argsort(term, kind="stable")
        self.docs, self.addends = doc[by_term], addend[by_term]
        self.starts = np.searchsorted(term[by_term], np.arange(len(weights) + 1))
        self.largest = np.zeros(len(weights), np.int64)
        used = np.nonzero(np.diff(self.starts))[0]
        if len(used):
            self.largest[used] = np.maximum.reduceat(self.addends, self.starts[used])

    def search(self, terms: np.ndarray, k: int, known: int) -> tuple[np.ndarray, np.ndarray]:
        """doc_ids and scores of the block's best ``k`` for a query whose ``terms`` come rarest first; none below ``known``."""
        score = np.zeros(len(self.ids), np.int64)
        terms = terms[self.largest[terms] > 0]
        still = self.largest[terms][::-1].cumsum()[::-1]
        alive = None
        for t, bound in zip(terms.tolist(), still.tolist()):
            docs, addends = (x[self.starts[t]:self.starts[t + 1]] for x in (self.docs, self.addends))
            if alive is None:
                made = score[score > 0]
                if len(made) >= k:
                    known = max(known, int(np.partition(made, len(made) - k)[len(made) - k]))
                if bound < known:
                    alive = score > 0
            if alive is not None:
                old = alive[docs]
                docs, addends = docs[old], addends[old]
            score[docs] += addends  # a document is once in a list
        found = np.nonzero(score >= max(known, 1))[0]
        best = found[np.lexsort((self.ids[found], -score[found]))[:k]]
        return self.ids[best], score[best]


def _search(forward: DataFrame, queries: list[np.ndarray], weights: np.ndarray, n_docs: int, n_all: int, k: int,
            known: np.ndarray) -> DataFrame:
    """The best ``k`` documents of each task for each query: query (its place), doc_id, score."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = known.copy()
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
        for batch in batches:
            if not batch.num_rows:
                continue
            block = Block(batch, weights, n_docs, n_all)
            for q, terms in enumerate(queries):
                ids, scores = block.search(terms, k, int(floor[q]))
                if len(ids):
                    ids, scores = np.concatenate([best[q][0], ids]), np.concatenate([best[q][1], scores])
                    top = np.lexsort((ids, -scores))[:k]
                    best[q] = ids[top], scores[top]
                    if len(top) == k:
                        floor[q] = max(floor[q], scores[top[-1]])
        for q, (ids, scores) in enumerate(best):
            if len(ids):
                yield pa.RecordBatch.from_pydict({"query": pa.array(np.full(len(ids), q, np.int32)), "doc_id": pa.array(ids), "score": pa.array(scores)})

    return forward.mapInArrow(apply, "query int, doc_id long, score long")


def _ranked(found: DataFrame, of: str, k: int) -> DataFrame:
    w = Window.partitionBy(of).orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _search_block(docs: DataFrame, items: list[tuple[int, list[bytes]]], k: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in items for t in terms}))}
    forward = stage(_forward(docs, vocabulary), "lexical-forward")
    n_docs, n_all = forward.agg(F.count(F.lit(1)), F.sum("n_terms")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for place, n in forward.select(F.explode("places").alias("place")).groupBy("place").count().collect():
        df[place] = n
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) for n in df], np.int64)
    queries = []
    for _, terms in items:
        places = np.array(sorted(vocabulary[t] for t in terms), np.int64)
        queries.append(places[np.argsort(df[places], kind="stable")])

    first = F.pmod(F.xxhash64("doc_id"), F.lit(FIRST_OF)) == 0
    none = np.zeros(len(items), np.int64)
    probe = stage(_ranked(_search(forward.filter(first), queries, weights, n_docs, n_all or 1, k, none), "query", k), "lexical-probe")
    known = none.copy()
    for q, score in probe.filter(F.col("rank") == k).select("query", "score").collect():  # a row a query of the block
        known[q] = score
    rest = _search(forward.filter(~first), queries, weights, n_docs, n_all or 1, k, known)
    best = _ranked(probe.select("query", "doc_id", "score").unionByName(rest), "query", k)
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "query int, item_id long")
    return stage(best.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"), "lexical-found")


def search(docs: DataFrame, queries: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``k`` best documents of ``docs`` (doc_id, text) for each of ``queries`` (item_id, text).

    Returns item_id (long), rank (int, from 1), doc_id (long), score (long), highest score
    first, ties to the smaller doc_id; documents of score 0 are not returned. A term of a
    query counts once, and rows of ``queries`` with one item_id are one query of all their
    terms. A null or empty text has no terms: such a document is in no count, such a query
    has no rows. Rows with a null id take no part. Rows of ``docs`` that repeat an id are
    documents each, so an id may be ranked more than once. Whole texts are cut into terms,
    a long one piece by piece. Empty tables give no rows. Other columns, of any name, are not read.

    The driver holds the terms of one block of queries: ``block_terms``, or those of one query if it has more.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    docs = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, t) for i, text in zip(b.column("item_id").to_pylist(), b.column("text")) for t in term_counts(text.as_py())]
            yield pa.RecordBatch.from_pydict({"item_id": pa.array([i for i, _ in rows], pa.int64()), "term": pa.array([t for _, t in rows], pa.binary())})

    asked = (queries.filter(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), text)
             .mapInArrow(cut, "item_id long, term binary").groupBy("item_id").agg(F.collect_set("term").alias("terms")).orderBy("item_id"))
    found, items, held = [], [], 0
    for row in asked.toLocalIterator():
        items.append((row.item_id, [bytes(t) for t in row.terms]))
        held += len(row.terms)
        if held >= block_terms:
            found.append(_search_block(docs, items, k))
            items, held = [], 0
    if items:
        found.append(_search_block(docs, items, k))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best of all ``documents`` for each ``benchmark`` item."""
    return search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS all_terms FROM d WHERE len(terms) > 0),
p AS (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM p GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
scored AS (SELECT item_id, doc_id,
                  sum(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT
                      * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // all_terms))))::BIGINT AS score
           FROM q JOIN tf USING (term) JOIN df USING (term), s GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 50
"""
