"""Joins of the staged report forms.

Sizes: the top-k table has at most k rows, so it is the only side broadcast by
hint. The hourly tables have one row per (date, hour) present in the data; they
are joined by equi-join and AQE turns the join into a broadcast at run time
when the measured side is small. Path tables come out of ``groupBy(path)``, so
both sides are already hash-partitioned on the join key and the sort-merge join
needs no further exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylog.functions import clf
from tallylog.operators.ranking import TOP_K, rank_by_position, top_k_paths

HOUR_KEYS = ["log_date", "log_hour"]


def _zero(col: str) -> F.Column:
    return F.coalesce(F.col(col), F.lit(0)).cast("bigint").alias(col)


def join_top_paths_hosts(path_totals: DataFrame, pairs: DataFrame, k: int = TOP_K) -> DataFrame:
    """Rank the top k of merged path totals, then count their distinct hosts from
    (path, host) pairs, distinct or not: the pairs of other paths go before any
    are compared. Missing host counts become 0."""
    top = top_k_paths(path_totals, k)
    counts = (
        pairs.join(F.broadcast(top.select("resource_path")), "resource_path", "left_semi")
        .groupBy("resource_path").agg(F.count_distinct("host").alias("distinct_host_count"))
    )
    joined = top.join(F.broadcast(counts), "resource_path", "left")
    return rank_by_position(joined).select(
        "rank", "resource_path", "request_count", "total_bytes", _zero("distinct_host_count"))


def join_errors_hosts(hourly: DataFrame, error_pairs: DataFrame) -> DataFrame:
    """Merged hourly counts (errors > 0) left-joined to distinct error hosts per hour."""
    hosts = error_pairs.groupBy(*HOUR_KEYS).agg(F.count(F.lit(1)).alias("distinct_error_hosts"))
    joined = hourly.join(hosts, HOUR_KEYS, "left")
    return joined.select(
        *HOUR_KEYS, "error_request_count", "total_request_count",
        clf.rate_6dp("error_request_count", "total_request_count").alias("error_rate"),
        _zero("distinct_error_hosts"))


def join_metrics_hosts(metrics: DataFrame, host_counts: DataFrame) -> DataFrame:
    """Per-path metrics inner-joined to per-path distinct host counts."""
    return metrics.join(host_counts, "resource_path", "inner").select(
        "resource_path", "request_count", "total_bytes", "distinct_host_count")


def hourly_parts(hourly: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three hourly tables (errors, error hosts, totals) out of one table of hourly counts
    (``aggregates.hourly_counts``), so that the records are read and shuffled once for all three.
    Write that table first: it has a row an hour, and each part reads it."""
    with_errors = hourly.filter(F.col("error_request_count") > 0)
    return (with_errors.select(*HOUR_KEYS, "error_request_count"), with_errors.select(*HOUR_KEYS, "distinct_error_hosts"),
            hourly.select(*HOUR_KEYS, "total_request_count"))


def join_hourly_three_way(errors: DataFrame, error_hosts: DataFrame, totals: DataFrame) -> DataFrame:
    """Errors x error hosts x totals on (log_date, log_hour), inner joins."""
    joined = errors.join(error_hosts, HOUR_KEYS, "inner").join(totals, HOUR_KEYS, "inner")
    return joined.select(
        *HOUR_KEYS, "error_request_count", "total_request_count",
        clf.rate_6dp("error_request_count", "total_request_count").alias("error_rate"),
        "distinct_error_hosts")


def merge_hourly_left(errors: DataFrame, error_hosts: DataFrame, totals: DataFrame) -> DataFrame:
    """Like J4 with outer defaults: a missing total or host count is 0 and the
    rate is 0 when the total is 0."""
    joined = errors.join(totals, HOUR_KEYS, "left").join(error_hosts, HOUR_KEYS, "left")
    total = F.coalesce(F.col("total_request_count"), F.lit(0))
    rate = F.coalesce(
        clf.rate_6dp("error_request_count", total), F.lit(0).cast("decimal(20,6)"))
    return joined.select(
        *HOUR_KEYS, "error_request_count", total.cast("bigint").alias("total_request_count"),
        rate.alias("error_rate"), _zero("distinct_error_hosts"))


def combine_stats_rows(**one_row_frames: DataFrame) -> DataFrame:
    """J6 without a cross join: one-row frames of one column each are stacked by name,
    the others' columns null, and folded into a single row by one global aggregate."""
    named = [f.withColumnRenamed(f.columns[0], n) for n, f in one_row_frames.items()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
    return stacked.agg(*[F.max(n).alias(n) for n in one_row_frames])
