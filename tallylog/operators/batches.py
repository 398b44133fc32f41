"""Batch statistics.

All of them are global or per-batch aggregates over the flagged lines (valid
and malformed together), so one scan yields every number and no join is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylog.functions import clf

RUN_STATS_COLUMNS = ["total_records", "num_batches", "avg_batch_size", "malformed_count"]


def num_batches(parsed: DataFrame) -> DataFrame:
    """max(batch_id) over parsed records; 0 when there are none."""
    return parsed.agg(F.coalesce(F.max("batch_id"), F.lit(0)).cast("bigint").alias("num_batches"))


def avg_batch_size_col(total: F.Column, batches: F.Column) -> F.Column:
    """Total / batches as DOUBLE; 0.0 when there is no batch."""
    return F.coalesce(F.try_divide(total.cast("double"), batches.cast("double")), F.lit(0.0))


def run_stats(flagged: DataFrame) -> DataFrame:
    """One row (total_records, num_batches, avg_batch_size, malformed_count)."""
    valid = F.col("is_valid")
    counts = flagged.agg(
        F.count_if(valid).alias("total_records"),
        F.coalesce(F.max(F.when(valid, F.col("batch_id"))), F.lit(0)).cast("bigint").alias("num_batches"),
        F.count_if(~valid).alias("malformed_count"),
    )
    return counts.select(
        "total_records", "num_batches",
        avg_batch_size_col(F.col("total_records"), F.col("num_batches")).alias("avg_batch_size"),
        "malformed_count",
    )


def avg_batch_size(flagged: DataFrame) -> DataFrame:
    return run_stats(flagged).select("avg_batch_size")


def batch_summary(flagged: DataFrame) -> DataFrame:
    """Per batch, parsed records, malformed lines and bytes of parsed records."""
    valid = F.col("is_valid")
    return flagged.groupBy("batch_id").agg(
        F.count_if(valid).alias("record_count"),
        F.count_if(~valid).alias("malformed_count"),
        clf.sum_bytes(F.when(valid, F.col("bytes_transferred"))).alias("total_bytes"),
    )


class EmptyRunError(RuntimeError):
    """Raised when a run parses zero records; nothing is written for it."""


def guard_empty_run(stats_row) -> None:
    """Refuse a run in which nothing was parsed."""
    if stats_row["total_records"] == 0:
        raise EmptyRunError(
            f"the run has no valid record, {stats_row['malformed_count']} lines were malformed; is this the right input?")
