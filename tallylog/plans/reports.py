"""The three reports composed from the operators, in two equivalent forms.

* direct: one group-by per report on the parsed records (what a Spark user
  writes; Catalyst adds the partial aggregates itself);
* staged: per-batch partials merged across batches, plus distinct-pair tables
  joined back in (the staged form, kept because its tables are user-visible).

Both must give the same rows; tests check that for several batch sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallylog.operators import aggregates as A
from tallylog.operators import joins as J
from tallylog.operators.ranking import TOP_K

QUERY_CHOICES = {"1": ["q1"], "2": ["q2"], "3": ["q3"], "all": ["q1", "q2", "q3"]}


def chosen(query: str) -> list[str]:
    try:
        return QUERY_CHOICES[str(query)]
    except KeyError:
        raise ValueError(f"query must be one of {sorted(QUERY_CHOICES)}, got {query!r}") from None


BUILDERS = {"q1": A.q1_daily_traffic, "q2": A.q2_top_resources, "q3": A.q3_hourly_errors}


def direct_reports(parsed: DataFrame, query: str = "all") -> dict[str, DataFrame]:
    return {q: BUILDERS[q](parsed) for q in chosen(query)}


def staged_q1(parsed: DataFrame) -> DataFrame:
    return A.q1_merge_partials(A.q1_partial(parsed))


def staged_q2(parsed: DataFrame, k: int = TOP_K) -> DataFrame:
    return J.join_top_paths_hosts(A.q2_merge_partials(A.q2_partial(parsed)), A.filter_has_path(parsed).select("resource_path", "host"), k)


def staged_q3(parsed: DataFrame) -> DataFrame:
    return J.join_errors_hosts(A.q3_merge_partials(A.q3_partial(parsed)), A.q3_distinct_pairs(parsed))


def staged_reports(parsed: DataFrame, query: str = "all") -> dict[str, DataFrame]:
    builders = {"q1": staged_q1, "q2": staged_q2, "q3": staged_q3}
    return {q: builders[q](parsed) for q in chosen(query)}
