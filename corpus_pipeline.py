"""The corpus pipeline: from ``documents`` to token ids, in five stages.

Each stage is a function of (spark, docs, sf_dir) and calls one operator; its result
is written as Parquet and read again as the next one's docs. All but the last return
the columns of documents.

A null text counts as empty: the classifier judges it as it judges an empty one, it has
no words, no PII and no tokens. Null languages and sources are a leaf of the mix of their
own. Repeated rows (one doc_id, one text) come out once, as near-dedup keeps one of each
component, that of the smallest doc_id; ties of the mix go by a keyed hash of the doc_id.
Other columns of the table are left out by the first stage. An empty table gives no rows.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallylog.llm import bpe, mixing, pii, quality, simhash  # noqa: E402
from tallylog.llm.common import stage, table  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: The mix takes so much of all tokens, and each document once at most.
MIX_SHARE, MIX_EPOCHS = 0.8, 1


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on all of ``docs``, keeps."""
    docs = docs.select(*COLUMNS)
    return quality.classify(docs, quality.fit(docs)).filter("keep").select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each SimHash component."""
    return simhash.keep_one(docs.select(*COLUMNS))


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for their PII; n_chars is that of the new text."""
    return pii.replace_pii(docs.select(*COLUMNS)).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix to the production weights selects."""
    return mixing.mix(docs.select(*COLUMNS), share=MIX_SHARE, max_epochs=MIX_EPOCHS).select(*COLUMNS)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and token_ids (little-endian unsigned 32-bit integers) of each document."""
    return bpe.encode(docs, bpe.vocabulary_path(), keep=["doc_id", "lang", "source"])


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", keep_one_of_each),
    ("PII surrogates", replace_private),
    ("mixing to target weights", mix_sources),
    ("BPE encoding", encode_texts),
]

#: Fitting, components and tokens are not expressible in SQL: tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result but the last is staged for the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{i + 1}")
    return docs
