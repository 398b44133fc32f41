"""The registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallylog.llm import bpe, langid, lexical, licences, mixing, neighbours, pii, quality, sharding, simhash, toxicity, whitening, winnowing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": bpe.op1_bpe,
    "op2_licences": licences.op2_licences,
    "op3_winnowing": winnowing.op3_winnowing,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_neighbours": neighbours.op5_neighbours,
    "op6_pii": pii.op6_pii,
    "op7_simhash": simhash.op7_simhash,
    "op8_mixing": mixing.op8_mixing,
    "op9_quality": quality.op9_quality,
    "op10_sharding": sharding.op10_sharding,
    "op11_lexical": lexical.op11_lexical,
    "op12_langid": langid.op12_langid,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op2_licences": licences.ORACLE_SQL,
    "op5_neighbours": neighbours.ORACLE_SQL,
    "op8_mixing": mixing.ORACLE_SQL,
    "op11_lexical": lexical.ORACLE_SQL,
}
