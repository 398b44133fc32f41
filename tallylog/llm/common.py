"""Helpers of the training-data operators: staged tables and table reading."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylog.session import staging_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The lineage ends there, so a lost executor costs no recomputation and values
    that depend on how rows are dealt (row ids) stay what they were.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def constants(values: list, kind: str) -> Column:
    """A constant array column, folded to one literal by the optimizer."""
    if not values:
        return F.array().cast(f"array<{kind}>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, also where ``body`` uses it within another lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
