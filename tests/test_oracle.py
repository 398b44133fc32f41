"""Every registered query against its DuckDB twin on the sf0.001 tables."""

from __future__ import annotations

import pytest
from oracle_compare import compare, duck, type_mismatches

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
KEYS = sorted(k for k in E.oracle_sql() if k not in E.LLM_QUERIES)  # those have tests of their own


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(E.queries()) - set(E.LLM_QUERIES) == set(E.oracle_sql()) - set(E.LLM_ORACLE_SQL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["log_date", "status_code", "request_count", "total_bytes"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    ok, msg = compare(df, con, E.oracle_sql()[key])
    assert ok, msg
    assert type_mismatches(df, con, E.oracle_sql()[key]) == []
