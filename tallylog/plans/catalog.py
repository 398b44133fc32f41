"""Every operator of the inventory as a query over the given tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame. All of them start
from the access log derived from the whole ``events`` table (fixture D); the
file-source entries first write that log as text files into the shared folder
and read it back, so their work grows with the tables too. The DuckDB twin of
each entry is in ``tallylog.oracle.ORACLE_SQL`` under the same key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylog.oracle import BATCH_SIZE
from tallylog.operators import aggregates as A
from tallylog.operators import batches as B
from tallylog.operators import joins as J
from tallylog.operators import parse as P
from tallylog.operators import ranking as W
from tallylog.plans import reports as R
from tallylog.plans.job import diff_stored_runs, run_report, run_report_job
from tallylog.session import staging_path
from tallylog.sources import ordinals as O
from tallylog.sources import store as S
from tallylog.sources import text as T
from tallylog.sources.eventlog import DAY_PREFIX, event_log_lines, write_event_log

Query = Callable[[SparkSession, str], DataFrame]

# ---------------------------------------------------------------- shared inputs

_written: dict[tuple, str] = {}


def _log_files(spark: SparkSession, sf_dir: str, compression: str | None = None) -> str:
    """The derived log as text files (written once per session, data and codec)."""
    key = (spark.sparkContext.applicationId, sf_dir, compression)
    if key not in _written:
        _written[key] = write_event_log(spark, sf_dir, compression=compression)
    return _written[key]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log_lines(spark, sf_dir)


def flagged(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The flagged lines with the parsed fields named (all unless given)."""
    return P.flag_lines(lines(spark, sf_dir), BATCH_SIZE, columns=list(columns) or None)


def parsed(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return P.project_parsed(P.filter_valid(flagged(spark, sf_dir, *columns)))


def staged(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The parsed records, written once for a query that reads them several times."""
    return S.materialize_parsed(parsed(spark, sf_dir, *columns), staging_path(spark, "parsed"))


def _file_lines(spark: SparkSession, sf_dir: str, compression: str | None = None) -> DataFrame:
    root = _log_files(spark, sf_dir, compression)
    tagged, _ = T.read_log_lines(spark, root, DAY_PREFIX)
    return tagged


def _job(spark: SparkSession, sf_dir: str, query: str = "all", batch_size: int | None = BATCH_SIZE):
    root = _log_files(spark, sf_dir)
    store_root = staging_path(spark, "store")
    run_id = run_report_job(spark, root, store_root, batch_size=batch_size, query=query, name_prefix=DAY_PREFIX)
    return store_root, run_id


# ---------------------------------------------------------------- S: sources, sinks

def scan_log_lines(spark, sf_dir):
    files = T.list_inputs(spark, _log_files(spark, sf_dir), DAY_PREFIX)
    return T.scan_lines(spark, files).select("raw")


def scan_gzip_lines(spark, sf_dir):
    files = T.list_inputs(spark, _log_files(spark, sf_dir, "gzip"), DAY_PREFIX)
    return T.scan_lines(spark, files).select("raw")


def decode_latin1(spark, sf_dir):
    """Each line with one more character, U+00C0 to U+00FF, written as one byte that is no UTF-8."""
    root = staging_path(spark, "latin1")
    text = F.concat(F.col("raw"), F.char(F.lit(192) + F.col("ordinal") % 64))
    lines(spark, sf_dir).select(F.encode(text, "ISO-8859-1").cast("string").alias("raw")).write.text(root)
    files = T.list_inputs(spark, root, "part-")
    return spark.read.text([T.escape_glob(f.path) for f in files]).select(
        T.decode_latin1(F.col("value")).alias("raw")).withColumn("n_chars", F.length("raw"))


def union_inputs(spark, sf_dir):
    plain = _log_files(spark, sf_dir)
    gz = _log_files(spark, sf_dir, "gzip")
    return T.union_inputs([
        T.scan_lines(spark, T.list_inputs(spark, plain, DAY_PREFIX)).select("raw"),
        T.scan_lines(spark, T.list_inputs(spark, gz, DAY_PREFIX)).select("raw"),
    ])


def tag_source_file(spark, sf_dir):
    return _file_lines(spark, sf_dir).select("raw", "file_entry", "file_index")


def write_results(spark, sf_dir):
    store_root = staging_path(spark, "store")
    S.write_results(R.direct_reports(parsed(spark, sf_dir, "log_date", "status_code", "bytes_transferred"), "1"), store_root, "run-s6")
    return S.read_table(spark, store_root, "q1_daily_traffic").filter(F.col("run_id") == "run-s6").drop("run_id")


def write_run_metadata(spark, sf_dir):
    store_root, run_id = _job(spark, sf_dir)
    runs = S.read_table(spark, store_root, "runs").filter(F.col("run_id") == run_id)
    return runs.select("pipeline", "query_name", "status", "batch_size", "num_batches",
                       "avg_batch_size", "total_records", "malformed_count")


def materialize_parsed(spark, sf_dir):
    return S.materialize_parsed(parsed(spark, sf_dir), staging_path(spark, "parsed"))


def read_run_results(spark, sf_dir):
    store_root, run_id = _job(spark, sf_dir)
    return S.read_run_results(spark, store_root, run_id)["q3"]


def write_line_batches(spark, sf_dir):
    numbered, offsets = O.number_lines(_file_lines(spark, sf_dir))
    root = O.write_line_batches(numbered, BATCH_SIZE, staging_path(spark, "batches"), offsets=offsets)
    again, _ = T.read_log_lines(spark, root, "batch_id=")
    return O.assign_ordinal(again).select("ordinal", O.batch_from_file_name().alias("batch_id"), "raw")


#: The column that a run of the key checks leaves empty, by table.
NULLED = {"runs": "pipeline", "q1_daily_traffic": "total_bytes", "q2_top_resources": "resource_path",
          "q3_hourly_errors": "error_rate", "batches": "total_bytes"}


def check_result_keys(spark, sf_dir):
    """A good run, one with each row twice, one with a null in each row; the latter two have no
    row in ``runs``, and a fourth run has two rows there, each with a null."""
    store_root, run_id = _job(spark, sf_dir)
    good = S.read_run_results(spark, store_root, run_id)
    nulled = {q: df.withColumn(NULLED[S.QUERY_TABLES.get(q, q)], F.lit(None).cast(df.schema[NULLED[S.QUERY_TABLES.get(q, q)]].dataType))
              for q, df in good.items()}
    reports = [*S.QUERY_TABLES, "batches"]
    S.write_results({q: good[q].unionByName(good[q]) for q in reports}, store_root, "doubled-run")
    S.write_results({q: nulled[q] for q in reports}, store_root, "nulled-run")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    twice = nulled["runs"].drop("run_id").withColumns({"started_at": at, "finished_at": at, "runtime_ms": F.lit(0).cast("bigint")})
    twice.unionByName(twice).write.parquet(f"{store_root}/runs/run_id=run-named-twice")
    return S.check_result_keys(spark, store_root)


def sweep_crashed_runs(spark, sf_dir):
    """What is in the store after a sweep: a complete run, one killed between two of its reports, one
    whose mark is lost as well, and one that is still in progress."""
    store_root, _ = _job(spark, sf_dir)
    q1 = A.q1_daily_traffic(parsed(spark, sf_dir, "log_date", "status_code", "bytes_transferred"))
    now = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=3)
    S.write_started(spark, store_root, "killed", now - dt.timedelta(days=3))
    S.write_started(spark, store_root, "in-progress", now - dt.timedelta(hours=1))
    for run_id in ("killed", "unmarked", "in-progress"):
        S.write_results({"q1": q1}, store_root, run_id)
    S.materialize_parsed(q1, f"{S.staging_folder(store_root, 'killed')}/parsed")
    S.sweep_crashed_runs(spark, store_root, older_than=dt.timedelta(days=1), now=now)
    kind = F.when(F.col("run_id").isin("killed", "unmarked", "in-progress"), F.col("run_id")).otherwise(F.lit("complete"))
    parts = [S.read_table(spark, store_root, t).groupBy(kind.alias("run")).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(t).alias("table_name"), "run", "n_rows") for t in [*S.PRIMARY_KEYS, "started"]]
    return T.union_inputs(parts)


# ---------------------------------------------------------------- P: parse

def extract_log_fields(spark, sf_dir):
    return P.extract_log_fields(lines(spark, sf_dir)).select(
        "ordinal", "host", "timestamp_raw", "request_raw", "status_raw", "bytes_raw")


def filter_valid(spark, sf_dir):
    return P.filter_valid(flagged(spark, sf_dir, *P.FIELD_COLUMNS)).select(
        "ordinal", "host", "timestamp_raw", "request_raw", "status_raw", "bytes_raw")


def count_malformed(spark, sf_dir):
    return P.count_malformed(flagged(spark, sf_dir, "is_valid"))


def derive_log_date(spark, sf_dir):
    return flagged(spark, sf_dir, "log_date").select("ordinal", "log_date")


def derive_log_hour(spark, sf_dir):
    return flagged(spark, sf_dir, "log_hour").select("ordinal", "log_hour")


def split_request(spark, sf_dir):
    return flagged(spark, sf_dir, "http_method", "resource_path", "protocol_version").select("ordinal", "http_method", "resource_path", "protocol_version")


def normalize_bytes(spark, sf_dir):
    return flagged(spark, sf_dir, "bytes_transferred").select("ordinal", "bytes_transferred")


def cast_status(spark, sf_dir):
    return P.filter_valid(flagged(spark, sf_dir, "status_code")).select("ordinal", "status_code")


def parse_access_log(spark, sf_dir):
    return P.parse_access_log(lines(spark, sf_dir), BATCH_SIZE)


def filter_has_path(spark, sf_dir):
    return P.filter_has_path(parsed(spark, sf_dir, "resource_path", "host")).select("ordinal", "resource_path", "host")


def filter_errors(spark, sf_dir):
    return P.filter_errors(parsed(spark, sf_dir, "log_date", "log_hour", "status_code", "host")).select("ordinal", "log_date", "log_hour", "status_code", "host")


def project_result_schema(spark, sf_dir):
    return P.project_record(parsed(spark, sf_dir))


# ---------------------------------------------------------------- B: ordinals, batches

def assign_ordinal(spark, sf_dir):
    return O.assign_ordinal(_file_lines(spark, sf_dir)).select("ordinal", "raw")


def batch_by_lines(spark, sf_dir):
    return P.with_batch_id(lines(spark, sf_dir), BATCH_SIZE).select("ordinal", "batch_id")


def batch_by_file(spark, sf_dir):
    return O.batch_by_file(_file_lines(spark, sf_dir)).select("raw", "batch_id")


def batch_from_file_name(spark, sf_dir):
    """Lines of files batch_NNN.log, but for every third batch, whose file has another name and index 7.

    Each batch is written as an entry of that name, and names are taken from the listed entries.
    """
    root = staging_path(spark, "named-batches")
    batched = P.with_batch_id(lines(spark, sf_dir), BATCH_SIZE)
    name = F.format_string("%s_%03d.log", F.when(F.col("batch_id") % 3 == 0, "other").otherwise("batch"), F.col("batch_id"))
    (batched.withColumn("entry", name).repartition("entry").sortWithinPartitions("entry", "ordinal")
     .select("entry", "raw").write.partitionBy("entry").text(root))
    # in the order of the numbers, whichever word is before them
    listed = sorted(T.list_inputs(spark, root, "entry="), key=lambda f: (int(f.entry.split("_")[1].split(".")[0]), f.file_order))
    files = [replace(f, file_order=i) for i, f in enumerate(listed, 1)]
    tagged = T.tag_source_file(T.scan_spread(T.pinned_session(spark), files), T.files_frame(spark, files))
    file_name = F.substring(F.col("file_entry"), len("entry=") + 1, 1 << 20)
    return O.assign_ordinal(tagged).select("ordinal", O.batch_from_file_name(file_name, F.lit(7)).alias("batch_id"))


def num_batches(spark, sf_dir):
    return B.num_batches(parsed(spark, sf_dir, "is_valid"))


def avg_batch_size(spark, sf_dir):
    return B.avg_batch_size(flagged(spark, sf_dir, "is_valid"))


def run_stats(spark, sf_dir):
    return B.run_stats(flagged(spark, sf_dir, "is_valid"))


def batch_summary(spark, sf_dir):
    """The batch table that a run stores."""
    store_root, run_id = _job(spark, sf_dir, query="1")
    return S.read_run_results(spark, store_root, run_id)["batches"]


def guard_empty_run(spark, sf_dir):
    """What the guard says of the whole log, and of its malformed lines alone."""
    every = flagged(spark, sf_dir, "is_valid")
    out = []
    for name, rows in (("whole log", every), ("malformed lines", every.filter(~F.col("is_valid")))):
        stats = B.run_stats(rows)
        try:
            B.guard_empty_run(stats.first())
            outcome = "accepted"
        except B.EmptyRunError:
            outcome = "refused"
        out.append(stats.select(F.lit(name).alias("input"), F.lit(outcome).alias("outcome"), "total_records", "malformed_count"))
    return T.union_inputs(out)


# ---------------------------------------------------------------- A: aggregations

def q1_partial(spark, sf_dir):
    return A.q1_partial(parsed(spark, sf_dir, "log_date", "status_code", "bytes_transferred"))


def q2_partial(spark, sf_dir):
    return A.q2_partial(parsed(spark, sf_dir, "resource_path", "bytes_transferred"))


def q3_partial(spark, sf_dir):
    return A.q3_partial(parsed(spark, sf_dir, "log_date", "log_hour", "status_code"))


def q1_daily_traffic(spark, sf_dir):
    return A.q1_daily_traffic(parsed(spark, sf_dir, "log_date", "status_code", "bytes_transferred"))


def q2_top_resources(spark, sf_dir):
    return A.q2_top_resources(staged(spark, sf_dir, "resource_path", "host", "bytes_transferred"))


def q3_hourly_errors(spark, sf_dir):
    return A.q3_hourly_errors(parsed(spark, sf_dir, "log_date", "log_hour", "status_code", "host"))


def q1_merge_partials(spark, sf_dir):
    return R.staged_q1(parsed(spark, sf_dir, "log_date", "status_code", "bytes_transferred"))


def q2_merge_partials(spark, sf_dir):
    return A.q2_merge_partials(A.q2_partial(parsed(spark, sf_dir, "resource_path", "bytes_transferred")))


def q3_merge_partials(spark, sf_dir):
    return A.q3_merge_partials(A.q3_partial(parsed(spark, sf_dir, "log_date", "log_hour", "status_code")))


def q2_distinct_pairs(spark, sf_dir):
    return A.q2_distinct_pairs(parsed(spark, sf_dir, "resource_path", "host"))


def q3_distinct_pairs(spark, sf_dir):
    return A.q3_distinct_pairs(parsed(spark, sf_dir, "log_date", "log_hour", "status_code", "host"))


def distinct_hosts_by_path(spark, sf_dir):
    return A.distinct_hosts_by_path(parsed(spark, sf_dir, "resource_path", "host"))


def distinct_error_hosts_by_hour(spark, sf_dir):
    return A.distinct_error_hosts_by_hour(parsed(spark, sf_dir, "log_date", "log_hour", "status_code", "host"))


def totals_by_hour(spark, sf_dir):
    return A.totals_by_hour(parsed(spark, sf_dir, "log_date", "log_hour"))


def errors_by_hour(spark, sf_dir):
    return A.errors_by_hour(parsed(spark, sf_dir, "log_date", "log_hour", "status_code"))


def total_records(spark, sf_dir):
    return A.total_records(parsed(spark, sf_dir, "is_valid"))


def error_rate(spark, sf_dir):
    return A.error_rate(A.q3_merge_partials(A.q3_partial(parsed(spark, sf_dir, "log_date", "log_hour", "status_code"))))


# ---------------------------------------------------------------- J: joins

def join_top_paths_hosts(spark, sf_dir):
    return R.staged_q2(staged(spark, sf_dir, "resource_path", "host", "bytes_transferred"))


def join_errors_hosts(spark, sf_dir):
    return R.staged_q3(staged(spark, sf_dir, "log_date", "log_hour", "status_code", "host"))


def join_metrics_hosts(spark, sf_dir):
    p = staged(spark, sf_dir, "resource_path", "host", "bytes_transferred")
    return J.join_metrics_hosts(A.path_metrics(p, with_hosts=False), A.distinct_hosts_by_path(p))


def _hourly_parts(spark, sf_dir):
    counts = A.hourly_counts(parsed(spark, sf_dir, "log_date", "log_hour", "status_code", "host"))
    return J.hourly_parts(S.materialize_parsed(counts, staging_path(spark, "hourly")))


def join_hourly_three_way(spark, sf_dir):
    return J.join_hourly_three_way(*_hourly_parts(spark, sf_dir))


def merge_hourly_left(spark, sf_dir):
    """Totals are given before noon and hosts from six o'clock on, so both defaults occur."""
    errors, hosts, totals = _hourly_parts(spark, sf_dir)
    return J.merge_hourly_left(errors, hosts.filter("log_hour >= 6"), totals.filter("log_hour < 12"))


def cross_join_stats(spark, sf_dir):
    f = S.materialize_parsed(flagged(spark, sf_dir, "is_valid").select("batch_id", "is_valid"), staging_path(spark, "flags"))
    valid = P.filter_valid(f)
    combined = J.combine_stats_rows(
        total_records=A.total_records(valid),
        num_batches=B.num_batches(valid),
        malformed_count=P.count_malformed(f),
    )
    return combined.select(
        "total_records", "num_batches",
        B.avg_batch_size_col(F.col("total_records"), F.col("num_batches")).alias("avg_batch_size"),
        "malformed_count")


# ---------------------------------------------------------------- W: sort, rank

def sort_q1(spark, sf_dir):
    return W.sort_q1(A.q1_daily_traffic(parsed(spark, sf_dir, "log_date", "status_code", "bytes_transferred")))


def top_k_paths(spark, sf_dir):
    return W.top_k_paths(A.path_metrics(parsed(spark, sf_dir, "resource_path", "bytes_transferred"), with_hosts=False))


def rank_by_position(spark, sf_dir):
    top = W.top_k_paths(A.path_metrics(parsed(spark, sf_dir, "resource_path", "bytes_transferred"), with_hosts=False))
    return W.rank_by_position(top).select("rank", "resource_path", "request_count")


def dense_rank_paths(spark, sf_dir):
    return W.dense_rank_paths(A.path_metrics(parsed(spark, sf_dir, "resource_path", "bytes_transferred"), with_hosts=False)).select(
        "rank", "resource_path", "request_count")


def sort_q3(spark, sf_dir):
    return W.sort_q3(A.q3_hourly_errors(parsed(spark, sf_dir, "log_date", "log_hour", "status_code", "host")))


def sort_q2_by_rank(spark, sf_dir):
    store_root, run_id = _job(spark, sf_dir, query="2")
    return W.sort_q2_by_rank(S.read_run_results(spark, store_root, run_id)["q2"])


# ---------------------------------------------------------------- U, K

def diff_runs_q3(spark, sf_dir):
    """Two stored runs, the second over the days 01 to 09 only."""
    root, store_root = _log_files(spark, sf_dir), staging_path(spark, "store")
    first, second = (run_report_job(spark, root, store_root, batch_size=BATCH_SIZE, query="3", name_prefix=prefix)
                     for prefix in (DAY_PREFIX, f"{DAY_PREFIX}2024-01-0"))
    return diff_stored_runs(spark, store_root, first, second, "q3")


def run_report_job_q2(spark, sf_dir):
    store_root, run_id = _job(spark, sf_dir, query="2", batch_size=None)
    return S.read_run_results(spark, store_root, run_id)["q2"]


def run_report_q1(spark, sf_dir):
    store_root, run_id = _job(spark, sf_dir)
    return run_report(spark, store_root, run_id)["q1"]


QUERIES: dict[str, Query] = {
    # S
    "scan_log_lines": scan_log_lines,
    "scan_gzip_lines": scan_gzip_lines,
    "decode_latin1": decode_latin1,
    "union_inputs": union_inputs,
    "tag_source_file": tag_source_file,
    "write_results": write_results,
    "write_run_metadata": write_run_metadata,
    "materialize_parsed": materialize_parsed,
    "read_run_results": read_run_results,
    "write_line_batches": write_line_batches,
    "check_result_keys": check_result_keys,
    "sweep_crashed_runs": sweep_crashed_runs,
    # P
    "extract_log_fields": extract_log_fields,
    "filter_valid": filter_valid,
    "count_malformed": count_malformed,
    "derive_log_date": derive_log_date,
    "derive_log_hour": derive_log_hour,
    "split_request": split_request,
    "normalize_bytes": normalize_bytes,
    "cast_status": cast_status,
    "parse_access_log": parse_access_log,
    "filter_has_path": filter_has_path,
    "filter_errors": filter_errors,
    "project_result_schema": project_result_schema,
    # B
    "assign_ordinal": assign_ordinal,
    "batch_by_lines": batch_by_lines,
    "batch_by_file": batch_by_file,
    "batch_from_file_name": batch_from_file_name,
    "num_batches": num_batches,
    "avg_batch_size": avg_batch_size,
    "run_stats": run_stats,
    "batch_summary": batch_summary,
    "guard_empty_run": guard_empty_run,
    # A
    "q1_partial": q1_partial,
    "q2_partial": q2_partial,
    "q3_partial": q3_partial,
    "q1_daily_traffic": q1_daily_traffic,
    "q2_top_resources": q2_top_resources,
    "q3_hourly_errors": q3_hourly_errors,
    "q1_merge_partials": q1_merge_partials,
    "q2_merge_partials": q2_merge_partials,
    "q3_merge_partials": q3_merge_partials,
    "q2_distinct_pairs": q2_distinct_pairs,
    "q3_distinct_pairs": q3_distinct_pairs,
    "distinct_hosts_by_path": distinct_hosts_by_path,
    "distinct_error_hosts_by_hour": distinct_error_hosts_by_hour,
    "totals_by_hour": totals_by_hour,
    "errors_by_hour": errors_by_hour,
    "total_records": total_records,
    "error_rate": error_rate,
    # J
    "join_top_paths_hosts": join_top_paths_hosts,
    "join_errors_hosts": join_errors_hosts,
    "join_metrics_hosts": join_metrics_hosts,
    "join_hourly_three_way": join_hourly_three_way,
    "merge_hourly_left": merge_hourly_left,
    "cross_join_stats": cross_join_stats,
    # W
    "sort_q1": sort_q1,
    "top_k_paths": top_k_paths,
    "rank_by_position": rank_by_position,
    "dense_rank_paths": dense_rank_paths,
    "sort_q3": sort_q3,
    "sort_q2_by_rank": sort_q2_by_rank,
    # U, K
    "diff_runs": diff_runs_q3,
    "run_report_job": run_report_job_q2,
    "run_report": run_report_q1,
}
