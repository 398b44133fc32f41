"""Batch formula (fixture C), evaluated by the Spark column expression itself."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallylog.functions.clf import batch_by_lines


def _batches(spark, ordinals, n):
    df = spark.createDataFrame([(o,) for o in ordinals], "ordinal bigint")
    return [r[0] for r in df.select(batch_by_lines("ordinal", n)).orderBy(F.col("ordinal")).collect()]


def test_n10_ordinals_1_to_25(spark):
    assert _batches(spark, range(1, 26), 10) == [1] * 10 + [2] * 10 + [3] * 5


def test_first_in_batch_is_one_indexed(spark):
    assert _batches(spark, [1, 100_000, 100_001], 100_000) == [1, 1, 2]


def test_partial_last_batch_still_counts(spark):
    assert _batches(spark, [17], 5) == [4]


def test_n_equal_to_total(spark):
    assert set(_batches(spark, range(1, 1001), 1000)) == {1}


def test_n_one(spark):
    assert _batches(spark, range(1, 11), 1) == list(range(1, 11))


@pytest.mark.parametrize("bad", [0, -3, None])
def test_batch_size_must_be_positive(bad):
    with pytest.raises(ValueError):
        batch_by_lines("ordinal", bad)
