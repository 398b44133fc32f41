"""Sort, limit and rank.

Ranks are only ever computed over the k rows left after the top-k step
(``TakeOrderedAndProject``: a per-partition top k, then a merge of
k x partitions rows), so no window moves a whole table into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOP_K = 20


def _path_order() -> list:
    return [F.col("request_count").desc(), F.col("resource_path").asc()]


def sort_q1(q1: DataFrame) -> DataFrame:
    return q1.orderBy("log_date", "status_code")


def top_k_paths(path_totals: DataFrame, k: int = TOP_K) -> DataFrame:
    """request_count DESC, resource_path ASC, first k."""
    return path_totals.orderBy(*_path_order()).limit(k)


def rank_by_position(top: DataFrame) -> DataFrame:
    """rank = 1-based position in the sorted top k (input already cut to k rows)."""
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*_path_order())).cast("int"))


def dense_rank_paths(path_totals: DataFrame, k: int = TOP_K) -> DataFrame:
    """Dense rank by (request_count DESC, resource_path ASC), ranks <= k.

    Paths are unique, so the ranks <= k are exactly the top k rows; the rank is
    taken over those rows only.
    """
    top = top_k_paths(path_totals, k)
    ranked = top.withColumn("rank", F.dense_rank().over(Window.orderBy(*_path_order())).cast("int"))
    return ranked.filter(F.col("rank") <= k)


def sort_q3(q3: DataFrame) -> DataFrame:
    return q3.orderBy("log_date", "log_hour")


def sort_q2_by_rank(q2: DataFrame) -> DataFrame:
    return q2.orderBy("rank")
