"""Aggregations.

All group-bys use built-in aggregates, so Spark plans a partial (map-side)
aggregate before each shuffle. Exact distinct counts use ``count_distinct``:
Spark first aggregates on (key, host), hashing both, so a hot path or hour is
spread over many tasks before the per-key count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylog.functions import clf
from tallylog.operators.parse import filter_errors, filter_has_path
from tallylog.operators.ranking import TOP_K, rank_by_position, top_k_paths


def _count() -> F.Column:
    return F.count(F.lit(1))


def _bytes_sum(col: str = "bytes_transferred") -> F.Column:
    return clf.sum_bytes(col)


# A1-A3: per-batch partials -------------------------------------------------

def q1_partial(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("batch_id", "log_date", "status_code").agg(
        _count().alias("request_count"), _bytes_sum().alias("total_bytes"))


def q2_partial(parsed: DataFrame) -> DataFrame:
    return filter_has_path(parsed).groupBy("batch_id", "resource_path").agg(
        _count().alias("request_count"), _bytes_sum().alias("total_bytes"))


def q3_partial(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("batch_id", "log_date", "log_hour").agg(
        F.count_if(clf.is_error("status_code")).alias("error_request_count"),
        _count().alias("total_request_count"))


# The three reports, direct form ------------------------------------

def q1_daily_traffic(parsed: DataFrame) -> DataFrame:
    """Per (log_date, status_code): request_count, total_bytes."""
    return parsed.groupBy("log_date", "status_code").agg(
        _count().alias("request_count"), _bytes_sum().alias("total_bytes"))


def path_metrics(parsed: DataFrame, with_hosts: bool = True) -> DataFrame:
    """Per resource_path: request_count, total_bytes and (exact) distinct_host_count."""
    aggs = [_count().alias("request_count"), _bytes_sum().alias("total_bytes")]
    if with_hosts:
        aggs.append(F.count_distinct("host").alias("distinct_host_count"))
    return filter_has_path(parsed).groupBy("resource_path").agg(*aggs)


def q2_top_resources(parsed: DataFrame, k: int = TOP_K) -> DataFrame:
    """Top k paths by request_count desc, path asc, with rank 1..k.

    The ranking needs only request counts, so the top k come from plain per-path
    totals; exact distinct hosts are counted for those k paths only, instead of
    shuffling every distinct (path, host) pair of the log. ``parsed`` is read twice:
    give it cached or written (``store.materialize_parsed``).
    """
    top = top_k_paths(path_metrics(parsed, with_hosts=False), k)
    hosts = (
        filter_has_path(parsed).join(F.broadcast(top.select("resource_path")), "resource_path", "left_semi")
        .groupBy("resource_path").agg(F.count_distinct("host").alias("distinct_host_count"))
    )
    return rank_by_position(top.join(F.broadcast(hosts), "resource_path", "left")).select(
        "rank", "resource_path", "request_count", "total_bytes",
        F.coalesce(F.col("distinct_host_count"), F.lit(0)).cast("bigint").alias("distinct_host_count"))


def hourly_counts(parsed: DataFrame) -> DataFrame:
    """Per (log_date, log_hour): errors, all requests and distinct error hosts, one pass."""
    err = clf.is_error("status_code")
    return parsed.groupBy("log_date", "log_hour").agg(
        F.count_if(err).alias("error_request_count"),
        _count().alias("total_request_count"),
        F.count_distinct(F.when(err, F.col("host"))).alias("distinct_error_hosts"),
    )


def with_error_rate(hourly: DataFrame) -> DataFrame:
    return hourly.withColumn(
        "error_rate", clf.rate_6dp("error_request_count", "total_request_count"))


Q3_COLUMNS = ["log_date", "log_hour", "error_request_count", "total_request_count",
              "error_rate", "distinct_error_hosts"]


def q3_hourly_errors(parsed: DataFrame) -> DataFrame:
    """Hours with at least one error: counts, rate (6 dp, half-even), distinct error hosts."""
    hourly = hourly_counts(parsed).filter(F.col("error_request_count") > 0)
    return with_error_rate(hourly).select(*Q3_COLUMNS)


# Merge per-batch partials -------------------------------------------

def q1_merge_partials(partials: DataFrame) -> DataFrame:
    return partials.groupBy("log_date", "status_code").agg(
        F.sum("request_count").cast("bigint").alias("request_count"),
        _bytes_sum("total_bytes").alias("total_bytes"))


def q2_merge_partials(partials: DataFrame) -> DataFrame:
    return partials.groupBy("resource_path").agg(
        F.sum("request_count").cast("bigint").alias("request_count"),
        _bytes_sum("total_bytes").alias("total_bytes"))


def q3_merge_partials(partials: DataFrame) -> DataFrame:
    merged = partials.groupBy("log_date", "log_hour").agg(
        F.sum("error_request_count").cast("bigint").alias("error_request_count"),
        F.sum("total_request_count").cast("bigint").alias("total_request_count"))
    return merged.filter(F.col("error_request_count") > 0)


# Staged building blocks -------------------------------------------

def q2_distinct_pairs(parsed: DataFrame) -> DataFrame:
    return filter_has_path(parsed).select("resource_path", "host").distinct()


def q3_distinct_pairs(parsed: DataFrame) -> DataFrame:
    return filter_errors(parsed).select("log_date", "log_hour", "host").distinct()


def distinct_hosts_by_path(parsed: DataFrame) -> DataFrame:
    return filter_has_path(parsed).groupBy("resource_path").agg(
        F.count_distinct("host").alias("distinct_host_count"))


def distinct_error_hosts_by_hour(parsed: DataFrame) -> DataFrame:
    return filter_errors(parsed).groupBy("log_date", "log_hour").agg(
        F.count_distinct("host").alias("distinct_error_hosts"))


def totals_by_hour(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("log_date", "log_hour").agg(_count().alias("total_request_count"))


def errors_by_hour(parsed: DataFrame) -> DataFrame:
    return filter_errors(parsed).groupBy("log_date", "log_hour").agg(
        _count().alias("error_request_count"))


def total_records(parsed: DataFrame) -> DataFrame:
    return parsed.agg(_count().alias("total_records"))


def error_rate(hourly: DataFrame) -> DataFrame:
    """(log_date, log_hour, error_rate) from error and total counts."""
    return with_error_rate(hourly).select("log_date", "log_hour", "error_rate")
