"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each query runs on the pre-registered ``events`` view: the CTEs below build the
same log text as ``tallylog.sources.eventlog`` and parse it with the same rules
as ``tallylog.functions.clf``, written independently in DuckDB's dialect.
"""

from __future__ import annotations

# Fixed value: the master pattern, written out here so that a slip in the engine's shows.
LOG_PATTERN = r'^(\S+) \S+ \S+ \[([^\]]+)\] "([^"]*)" (\d{3}|-) (\d+|-)$'

# Line batch size used by every batch-aware registered query.
BATCH_SIZE = 1000
TOP_K = 20

_LINES = """lines AS (
  SELECT event_id + 1 AS ordinal,
    CASE
      WHEN event_id % 97 = 5 THEN 'garbage line ' || CAST(event_id AS VARCHAR)
      WHEN event_id % 211 = 7 THEN ''
      ELSE 'host' || CAST(user_id AS VARCHAR) || '.example.org - - ['
        || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0400] "'
        || CASE
             WHEN event_id % 53 = 3 THEN 'GET'
             WHEN event_id % 59 = 4 THEN '   '
             WHEN event_id % 61 = 6 THEN 'GET /' || event_type
             ELSE 'GET /' || event_type || '/' || CAST(event_id % 40 AS VARCHAR) || '.html HTTP/1.0'
           END
        || '" '
        || CASE
             WHEN event_id % 101 = 9 THEN '-'
             WHEN event_type = 'error' AND event_id % 3 = 0 THEN '500'
             WHEN event_type = 'error' THEN '404'
             WHEN event_id % 11 = 0 THEN '304'
             ELSE '200'
           END
        || ' '
        || CASE WHEN event_id % 7 = 0 THEN '-' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END
    END AS raw,
    strftime(ts, '%Y-%m-%d') AS day
  FROM events
)"""

_FIELDS = """fields AS (
  SELECT ordinal, raw, day,
    regexp_extract(raw, '@P@', 1) AS host,
    regexp_extract(raw, '@P@', 2) AS timestamp_raw,
    regexp_extract(raw, '@P@', 3) AS request_raw,
    regexp_extract(raw, '@P@', 4) AS status_raw,
    regexp_extract(raw, '@P@', 5) AS bytes_raw
  FROM lines
)""".replace("@P@", LOG_PATTERN)

_DERIVED = """derived AS (
  SELECT *,
    CASE WHEN substr(timestamp_raw, 4, 3) IN ('Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug',
                                              'Sep', 'Oct', 'Nov', 'Dec')
              AND substr(timestamp_raw, 8, 4) <> '0000'
         THEN CAST(try_strptime(substr(timestamp_raw, 1, 11), '%d/%b/%Y') AS DATE) END AS log_date,
    TRY_CAST(substr(timestamp_raw, 13, 2) AS INTEGER) AS log_hour,
    list_filter(regexp_split_to_array(request_raw, '\\s+'), lambda t: t <> '') AS tokens
  FROM fields
)"""

_FLAGGED = """flagged AS (
  SELECT ordinal, raw, day, host, timestamp_raw, request_raw, status_raw, bytes_raw, log_date, log_hour,
    COALESCE(status_raw <> '' AND status_raw <> '-' AND log_date IS NOT NULL
             AND log_hour BETWEEN 0 AND 23, false) AS is_valid,
    tokens[1] AS http_method, tokens[2] AS resource_path, tokens[3] AS protocol_version,
    TRY_CAST(status_raw AS INTEGER) AS status_code,
    CASE WHEN bytes_raw = '-' THEN CAST(0 AS BIGINT)
         ELSE COALESCE(TRY_CAST(bytes_raw AS BIGINT), CAST(0 AS BIGINT)) END AS bytes_transferred,
    CAST((ordinal - 1) // @N@ + 1 AS BIGINT) AS batch_id
  FROM derived
)""".replace("@N@", str(BATCH_SIZE))

_PARSED = """parsed AS (
  SELECT ordinal, batch_id, host, timestamp_raw, log_date, log_hour, http_method,
         resource_path, protocol_version, status_code, bytes_transferred
  FROM flagged WHERE is_valid
)"""

PREFIX = "WITH " + ",\n".join([_LINES, _FIELDS, _DERIVED, _FLAGGED, _PARSED]) + "\n"


def rate_sql(e: str, t: str) -> str:
    """Half-even six-decimal rate in integers, as DECIMAL(20,6); NULL when t = 0."""
    n = f"(CAST({e} AS BIGINT) * 1000000)"
    q = f"({n} // {t})"
    r = f"({n} % {t})"
    up = f"(2 * {r} > {t} OR (2 * {r} = {t} AND {q} % 2 = 1))"
    return (f"CASE WHEN {t} > 0 THEN CAST(CAST({q} + CASE WHEN {up} THEN 1 ELSE 0 END AS DOUBLE)"
            f" / 1000000 AS DECIMAL(20,6)) END")


def q(body: str) -> str:
    return PREFIX + body


# Reusable bodies -------------------------------------------------------------

Q1 = """SELECT log_date, status_code, CAST(count(*) AS BIGINT) AS request_count,
       CAST(COALESCE(sum(bytes_transferred), 0) AS BIGINT) AS total_bytes
FROM parsed GROUP BY log_date, status_code"""

PATH_METRICS = """path_metrics AS (
  SELECT resource_path, CAST(count(*) AS BIGINT) AS request_count,
         CAST(COALESCE(sum(bytes_transferred), 0) AS BIGINT) AS total_bytes,
         CAST(count(DISTINCT host) AS BIGINT) AS distinct_host_count
  FROM parsed WHERE resource_path IS NOT NULL GROUP BY resource_path
)"""

Q2 = (", " + PATH_METRICS + """
SELECT CAST(row_number() OVER (ORDER BY request_count DESC, resource_path ASC) AS INTEGER) AS rank,
       resource_path, request_count, total_bytes, distinct_host_count
FROM path_metrics ORDER BY request_count DESC, resource_path ASC LIMIT @K@""").replace("@K@", str(TOP_K))

HOURLY = """hourly AS (
  SELECT log_date, log_hour,
         CAST(count(*) FILTER (WHERE status_code BETWEEN 400 AND 599) AS BIGINT) AS error_request_count,
         CAST(count(*) AS BIGINT) AS total_request_count,
         CAST(count(DISTINCT host) FILTER (WHERE status_code BETWEEN 400 AND 599) AS BIGINT) AS distinct_error_hosts
  FROM parsed GROUP BY log_date, log_hour
)"""

Q3 = ", " + HOURLY + f"""
SELECT log_date, log_hour, error_request_count, total_request_count,
       {rate_sql('error_request_count', 'total_request_count')} AS error_rate,
       distinct_error_hosts
FROM hourly WHERE error_request_count > 0"""

RUN_STATS = """SELECT CAST(count(*) FILTER (WHERE is_valid) AS BIGINT) AS total_records,
       CAST(COALESCE(max(batch_id) FILTER (WHERE is_valid), 0) AS BIGINT) AS num_batches,
       COALESCE(CAST(count(*) FILTER (WHERE is_valid) AS DOUBLE)
                / NULLIF(CAST(COALESCE(max(batch_id) FILTER (WHERE is_valid), 0) AS DOUBLE), 0), 0.0) AS avg_batch_size,
       CAST(count(*) FILTER (WHERE NOT is_valid) AS BIGINT) AS malformed_count
FROM flagged"""

ERR = "status_code BETWEEN 400 AND 599"
DAY_INDEX = "CAST(dense_rank() OVER (ORDER BY day) AS INTEGER)"
RECORD = ("host, timestamp_raw, log_date, log_hour, http_method, resource_path, "
          "protocol_version, status_code, bytes_transferred")
TOP_PATHS = ", " + PATH_METRICS + """
, top_paths AS (
  SELECT CAST(row_number() OVER (ORDER BY request_count DESC, resource_path ASC) AS INTEGER) AS rank,
         resource_path, request_count, total_bytes
  FROM path_metrics ORDER BY request_count DESC, resource_path ASC LIMIT @K@
)""".replace("@K@", str(TOP_K))


BATCHES = """SELECT batch_id, CAST(count(*) FILTER (WHERE is_valid) AS BIGINT) AS record_count,
       CAST(count(*) FILTER (WHERE NOT is_valid) AS BIGINT) AS malformed_count,
       CAST(COALESCE(sum(bytes_transferred) FILTER (WHERE is_valid), 0) AS BIGINT) AS total_bytes
FROM flagged GROUP BY batch_id"""

REPORT_COLUMNS = {
    "q1_daily_traffic": ["log_date", "status_code", "request_count", "total_bytes"],
    "q2_top_resources": ["rank", "resource_path", "request_count", "total_bytes", "distinct_host_count"],
    "q3_hourly_errors": ["log_date", "log_hour", "error_request_count", "total_request_count", "error_rate", "distinct_error_hosts"],
    "batches": ["batch_id", "record_count", "malformed_count", "total_bytes"],
}
REPORT_KEYS = {"q1_daily_traffic": 2, "q2_top_resources": 1, "q3_hourly_errors": 2, "batches": 1}  # so many columns from the left
REPORT_NULLS = {"q1_daily_traffic": "total_bytes", "q2_top_resources": "resource_path", "q3_hourly_errors": "error_rate", "batches": "total_bytes"}

REPORTS = f""", {PATH_METRICS}, {HOURLY},
q1_daily_traffic AS ({Q1}),
q2_top_resources AS ({Q2[Q2.index("SELECT CAST(row_number"):]}),
q3_hourly_errors AS ({Q3[Q3.rindex("SELECT log_date, log_hour, error_request_count"):]}),
batches AS ({BATCHES}),
stats AS ({RUN_STATS})
"""


def _detail(run: str, columns: list[str]) -> str:
    """The JSON text of the columns of a row that are not null, all as strings."""
    return f"'{{\"run_id\":\"{run}\"' || " + " || ".join(f"',\"{c}\":\"' || CAST({c} AS VARCHAR) || '\"'" for c in columns) + " || '}'"


# Of each report, a run holds each row twice and another a null in each; neither is in ``runs``.
# A third run is there twice, each time with a null.
BAD_KEYS = REPORTS + " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, 'duplicate_key' AS violation, 'doubled-run' AS run_id, {_detail("doubled-run", cols[:REPORT_KEYS[t]])} AS detail FROM {t}
UNION ALL SELECT '{t}', 'missing_run', 'doubled-run', NULL UNION ALL SELECT '{t}', 'missing_run', 'nulled-run', NULL
UNION ALL SELECT '{t}', 'null_value', 'nulled-run', {_detail("nulled-run", [c for c in cols if c != REPORT_NULLS[t]])} FROM {t}"""
    for t, cols in REPORT_COLUMNS.items()) + f"""
UNION ALL SELECT 'runs', 'duplicate_key', 'run-named-twice', '{{"run_id":"run-named-twice"}}'
UNION ALL SELECT 'runs', 'null_value', 'run-named-twice',
  '{{"run_id":"run-named-twice","query_name":"all","status":"completed","started_at":"2024-01-01 00:00:00","finished_at":"2024-01-01 00:00:00",'
  || '"runtime_ms":"0","batch_size":"{BATCH_SIZE}","num_batches":"' || num_batches || '","avg_batch_size":"' || CAST(avg_batch_size AS VARCHAR)
  || '","total_records":"' || total_records || '","malformed_count":"' || malformed_count || '"}}'
FROM stats, range(2)"""

# A complete run, and the one that is still in progress.
SWEPT = REPORTS + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, 'complete' AS run, CAST(count(*) AS BIGINT) AS n_rows FROM {t}" for t in REPORT_COLUMNS) + """
UNION ALL SELECT 'runs', 'complete', CAST(1 AS BIGINT)
UNION ALL SELECT 'q1_daily_traffic', 'in-progress', CAST(count(*) AS BIGINT) FROM q1_daily_traffic
UNION ALL SELECT 'started', 'in-progress', CAST(1 AS BIGINT)"""

# Hourly errors where totals are known before noon and hosts from six o'clock on.
PARTLY_KNOWN = ", " + HOURLY + f""", known AS (
  SELECT log_date, log_hour, error_request_count,
         CASE WHEN log_hour < 12 THEN total_request_count ELSE 0 END AS total_request_count,
         CASE WHEN log_hour >= 6 THEN distinct_error_hosts ELSE 0 END AS distinct_error_hosts
  FROM hourly WHERE error_request_count > 0)
SELECT log_date, log_hour, error_request_count, CAST(total_request_count AS BIGINT) AS total_request_count,
       CAST(COALESCE({rate_sql('error_request_count', 'total_request_count')}, 0) AS DECIMAL(20,6)) AS error_rate,
       CAST(distinct_error_hosts AS BIGINT) AS distinct_error_hosts
FROM known"""

BODIES = {
    # S
    "scan_log_lines": "SELECT raw FROM lines",
    "scan_gzip_lines": "SELECT raw FROM lines",
    "decode_latin1": "SELECT raw || chr(CAST(192 + ordinal % 64 AS INTEGER)) AS raw, CAST(length(raw) + 1 AS INTEGER) AS n_chars FROM lines",
    "union_inputs": "SELECT raw FROM lines UNION ALL SELECT raw FROM lines",
    "tag_source_file": f"SELECT raw, 'day=' || day AS file_entry, {DAY_INDEX} AS file_index FROM lines",
    "write_results": Q1,
    "write_run_metadata": (
        "SELECT 'spark' AS pipeline, 'all' AS query_name, 'completed' AS status, "
        f"CAST({BATCH_SIZE} AS INTEGER) AS batch_size, num_batches, avg_batch_size, total_records, "
        f"malformed_count FROM ({RUN_STATS}) AS s"),
    "materialize_parsed": "SELECT * FROM parsed",
    "read_run_results": Q3,
    "write_line_batches": "SELECT ordinal, batch_id, raw FROM flagged",
    "check_result_keys": BAD_KEYS,
    "sweep_crashed_runs": SWEPT,
    # P
    "extract_log_fields": "SELECT ordinal, host, timestamp_raw, request_raw, status_raw, bytes_raw FROM fields",
    "filter_valid": ("SELECT ordinal, host, timestamp_raw, request_raw, status_raw, bytes_raw "
                     "FROM flagged WHERE is_valid"),
    "count_malformed": "SELECT CAST(count(*) FILTER (WHERE NOT is_valid) AS BIGINT) AS malformed_count FROM flagged",
    "derive_log_date": "SELECT ordinal, log_date FROM flagged",
    "derive_log_hour": "SELECT ordinal, log_hour FROM flagged",
    "split_request": "SELECT ordinal, http_method, resource_path, protocol_version FROM flagged",
    "normalize_bytes": "SELECT ordinal, bytes_transferred FROM flagged",
    "cast_status": "SELECT ordinal, status_code FROM flagged WHERE is_valid",
    "parse_access_log": "SELECT * FROM parsed",
    "filter_has_path": "SELECT ordinal, resource_path, host FROM parsed WHERE resource_path IS NOT NULL",
    "filter_errors": f"SELECT ordinal, log_date, log_hour, status_code, host FROM parsed WHERE {ERR}",
    "project_result_schema": f"SELECT {RECORD} FROM parsed",
    # B
    "assign_ordinal": "SELECT ordinal, raw FROM lines",
    "batch_by_lines": "SELECT ordinal, batch_id FROM flagged",
    "batch_by_file": f"SELECT raw, CAST({DAY_INDEX} AS BIGINT) AS batch_id FROM lines",
    "batch_from_file_name": "SELECT ordinal, CAST(CASE WHEN batch_id % 3 = 0 THEN 7 ELSE batch_id END AS BIGINT) AS batch_id FROM flagged",
    "num_batches": "SELECT CAST(COALESCE(max(batch_id), 0) AS BIGINT) AS num_batches FROM parsed",
    "avg_batch_size": f"SELECT avg_batch_size FROM ({RUN_STATS}) AS s",
    "run_stats": RUN_STATS,
    "batch_summary": BATCHES,
    "guard_empty_run": (
        f"SELECT 'whole log' AS input, CASE WHEN total_records = 0 THEN 'refused' ELSE 'accepted' END AS outcome, total_records, malformed_count "
        f"FROM ({RUN_STATS}) AS s UNION ALL SELECT 'malformed lines', 'refused', CAST(0 AS BIGINT), malformed_count FROM ({RUN_STATS}) AS s"),
    # A
    "q1_partial": ("SELECT batch_id, log_date, status_code, CAST(count(*) AS BIGINT) AS request_count, "
                   "CAST(COALESCE(sum(bytes_transferred), 0) AS BIGINT) AS total_bytes "
                   "FROM parsed GROUP BY batch_id, log_date, status_code"),
    "q2_partial": ("SELECT batch_id, resource_path, CAST(count(*) AS BIGINT) AS request_count, "
                   "CAST(COALESCE(sum(bytes_transferred), 0) AS BIGINT) AS total_bytes "
                   "FROM parsed WHERE resource_path IS NOT NULL GROUP BY batch_id, resource_path"),
    "q3_partial": (f"SELECT batch_id, log_date, log_hour, CAST(count(*) FILTER (WHERE {ERR}) AS BIGINT) "
                   "AS error_request_count, CAST(count(*) AS BIGINT) AS total_request_count "
                   "FROM parsed GROUP BY batch_id, log_date, log_hour"),
    "q1_daily_traffic": Q1,
    "q2_top_resources": Q2,
    "q3_hourly_errors": Q3,
    "q1_merge_partials": Q1,
    "q2_merge_partials": ", " + PATH_METRICS + "\nSELECT resource_path, request_count, total_bytes FROM path_metrics",
    "q3_merge_partials": (", " + HOURLY + "\nSELECT log_date, log_hour, error_request_count, "
                          "total_request_count FROM hourly WHERE error_request_count > 0"),
    "q2_distinct_pairs": "SELECT DISTINCT resource_path, host FROM parsed WHERE resource_path IS NOT NULL",
    "q3_distinct_pairs": f"SELECT DISTINCT log_date, log_hour, host FROM parsed WHERE {ERR}",
    "distinct_hosts_by_path": ", " + PATH_METRICS + "\nSELECT resource_path, distinct_host_count FROM path_metrics",
    "distinct_error_hosts_by_hour": (
        "SELECT log_date, log_hour, CAST(count(DISTINCT host) AS BIGINT) AS distinct_error_hosts "
        f"FROM parsed WHERE {ERR} GROUP BY log_date, log_hour"),
    "totals_by_hour": ("SELECT log_date, log_hour, CAST(count(*) AS BIGINT) AS total_request_count "
                       "FROM parsed GROUP BY log_date, log_hour"),
    "errors_by_hour": ("SELECT log_date, log_hour, CAST(count(*) AS BIGINT) AS error_request_count "
                       f"FROM parsed WHERE {ERR} GROUP BY log_date, log_hour"),
    "total_records": "SELECT CAST(count(*) AS BIGINT) AS total_records FROM parsed",
    "error_rate": (", " + HOURLY + "\nSELECT log_date, log_hour, "
                   + rate_sql("error_request_count", "total_request_count")
                   + " AS error_rate FROM hourly WHERE error_request_count > 0"),
    # J
    "join_top_paths_hosts": Q2,
    "join_errors_hosts": Q3,
    "join_metrics_hosts": (", " + PATH_METRICS + "\nSELECT resource_path, request_count, total_bytes, "
                           "distinct_host_count FROM path_metrics"),
    "join_hourly_three_way": Q3,
    "merge_hourly_left": PARTLY_KNOWN,
    "cross_join_stats": RUN_STATS,
    # W
    "sort_q1": Q1,
    "top_k_paths": TOP_PATHS + "\nSELECT resource_path, request_count, total_bytes FROM top_paths",
    "rank_by_position": TOP_PATHS + "\nSELECT rank, resource_path, request_count FROM top_paths",
    "dense_rank_paths": TOP_PATHS + "\nSELECT rank, resource_path, request_count FROM top_paths",
    "sort_q3": Q3,
    "sort_q2_by_rank": Q2,
    # U, K
    "diff_runs": f"SELECT 'only_in_first' AS side, s.* FROM (WITH {Q3.lstrip(', ')}) AS s WHERE strftime(log_date, '%d') >= '10'",
    "run_report_job": Q2,
    "run_report": Q1,
}

ORACLE_SQL: dict[str, str] = {key: q(body) for key, body in BODIES.items()}
