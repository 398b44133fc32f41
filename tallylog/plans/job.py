"""The job surface (K1, K2).

``run_report_job`` is what a ``spark-submit`` entry point calls: read the inputs,
parse once into a staged table, take the run statistics and the batches from it,
compute and write the chosen reports, then write the ``runs`` row. Only the one-row
run statistics come back to the driver.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
import warnings
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylog.functions import clf
from tallylog.operators import aggregates as A
from tallylog.operators import batches as B
from tallylog.operators.parse import flag_lines, project_parsed
from tallylog.operators.setops import diff_runs
from tallylog.plans.reports import BUILDERS, chosen
from tallylog.sources import store
from tallylog.sources.ordinals import SPLIT_COLUMNS, file_batch_stats, line_batch_stats, number_with, write_split_table
from tallylog.sources.text import DEFAULT_PREFIX, files_frame, list_inputs, scan_spread

# Columns each report reads; the statistics and batches read is_valid and bytes.
REPORT_INPUTS = {
    "q1": ["log_date", "status_code", "bytes_transferred"],
    "q2": ["resource_path", "host", "bytes_transferred"],
    "q3": ["log_date", "log_hour", "status_code", "host"],
}
_RECORD_COLUMNS = ["host", "timestamp_raw", "log_date", "log_hour", "http_method", "resource_path",
                   "protocol_version", "status_code", "bytes_transferred"]


def staged_columns(query: str, keep_staging: bool) -> list[str]:
    """Which parsed fields to stage: the whole record when it is kept, else only what is read."""
    needed = {"bytes_transferred"}.union(*[REPORT_INPUTS[q] for q in chosen(query)])
    return [c for c in _RECORD_COLUMNS if keep_staging or c in needed]


def write_reports_concurrently(parsed: DataFrame, batches: DataFrame, query: str, store_root: str, run_id: str) -> None:
    """The batches and each chosen report are built and written by a thread of their own:
    independent Spark jobs over the same staged data, so their small final stages overlap."""
    builds = {q: (lambda q=q: BUILDERS[q](parsed)) for q in chosen(query)} | {"batches": lambda: batches}
    with ThreadPoolExecutor(max_workers=len(builds)) as pool:
        for f in [pool.submit(lambda q=q, b=b: store.write_results({q: b()}, store_root, run_id)) for q, b in builds.items()]:
            f.result()


# What a kept run leaves in staging next to the records: per-batch partials and
# distinct pairs, the user-visible intermediate tables of the staged report form.
KEPT_STAGES = {
    "q1_partial": A.q1_partial, "q2_partial": A.q2_partial, "q3_partial": A.q3_partial,
    "q2_pairs": A.q2_distinct_pairs, "q3_pairs": A.q3_distinct_pairs,
}


def write_kept_stages(parsed: DataFrame, staging_root: str) -> None:
    with ThreadPoolExecutor(max_workers=len(KEPT_STAGES)) as pool:
        futures = [pool.submit(lambda n=name, f=fn: f(parsed).write.mode("errorifexists")
                               .parquet(f"{staging_root}/{n}"))
                   for name, fn in KEPT_STAGES.items()]
        for f in futures:
            f.result()


def _now() -> dt.datetime:
    """The current instant, zone-aware, so the stored TIMESTAMP does not depend on the
    driver host's local zone."""
    return dt.datetime.now(dt.timezone.utc)


def run_report_job(
    spark: SparkSession,
    input_path,
    store_root: str,
    *,
    batch_size: int | None = None,
    query: str = "all",
    name_prefix: str = DEFAULT_PREFIX,
    keep_staging: bool = False,
    pipeline: str = "spark",
) -> str:
    """K1: one full run; returns its ``run_id``.

    ``batch_size`` None means one batch per input file. ``query`` is ``1``,
    ``2``, ``3`` or ``all``; only the chosen reports are computed and written.
    The clock starts before the first read and stops after the last report is
    written (D16). The text is read once: the parsed columns that the run reads are
    written, with their split keys and row ids, under the store's staging folder, and
    everything else comes from there. That folder is dropped at the end, unless
    ``keep_staging``; a run that fails drops all it has written. A clean-up that fails is a warning: the run is
    what its ``runs`` row says, and ``store.sweep_crashed_runs`` drops what is left. So it
    does after a run that was killed, whose mark was written before anything else.
    """
    if batch_size is not None and int(batch_size) <= 0:
        raise ValueError("batch size must be a positive integer")
    columns = staged_columns(query, keep_staging)  # also validates the choice
    run_id = uuid.uuid4().hex
    staging_root = store.staging_folder(store_root, run_id)
    started_at = _now()
    t0 = time.monotonic()

    files = list_inputs(spark, input_path, name_prefix)
    flagged = flag_lines(scan_spread(spark, files), columns=columns)
    complete = False
    store.write_started(spark, store_root, run_id, started_at, keep_staging)
    try:
        staged = store.materialize_parsed(flagged.select("is_valid", *columns, *SPLIT_COLUMNS), f"{staging_root}/parsed")
        # one row a split: the file table meets this, not the lines
        offsets = write_split_table(staged, files_frame(spark, files), f"{staging_root}/splits")
        stats = (line_batch_stats(offsets, batch_size) if batch_size is not None else file_batch_stats(offsets)).first()
        B.guard_empty_run(stats)
        numbered = number_with(staged, offsets)
        batch_id = clf.batch_by_lines("ordinal", batch_size) if batch_size is not None else F.col("file_index").cast("bigint")
        numbered = numbered.withColumn("batch_id", batch_id)
        # the reports read no batch, so they read the staged records without the numbering join
        parsed = project_parsed(staged.filter(F.col("is_valid")))
        write_reports_concurrently(parsed, B.batch_summary(numbered), query, store_root, run_id)
        runtime_ms = int((time.monotonic() - t0) * 1000)
        finished_at = _now()
        if keep_staging:
            flagged_path = f"{staging_root}/flagged"
            rows = store.materialize_parsed(numbered.select("is_valid", "ordinal", "batch_id", *columns), flagged_path)
            write_kept_stages(project_parsed(rows.filter(F.col("is_valid"))), staging_root)
        store.write_run_metadata(spark, store_root, {
            "run_id": run_id, "pipeline": pipeline, "query_name": str(query), "status": "completed",
            "started_at": started_at, "finished_at": finished_at, "runtime_ms": runtime_ms,
            "batch_size": int(batch_size) if batch_size is not None else 0,
            "num_batches": int(stats["num_batches"]), "avg_batch_size": float(stats["avg_batch_size"]),
            "total_records": int(stats["total_records"]), "malformed_count": int(stats["malformed_count"]),
        })
        complete = True
    finally:
        _clean_up(spark, store_root, run_id, complete, keep_staging)
    return run_id


def _clean_up(spark: SparkSession, store_root: str, run_id: str, complete: bool, keep_staging: bool) -> None:
    try:
        if complete:
            store.finish_run(spark, store_root, run_id, keep_staging)
        else:
            store.discard_run(spark, store_root, run_id)
    except Exception as exc:  # whatever it is, it must not hide how the run itself ended
        warnings.warn(f"what run {run_id} no longer needs is left for a sweep: {exc}", stacklevel=2)


def run_report(spark: SparkSession, store_root: str, run_id: str) -> dict[str, DataFrame]:
    """K2: the run's metadata (with query_name), its three reports and its batches, in report order."""
    return store.read_run_results(spark, store_root, run_id)


def diff_stored_runs(spark: SparkSession, store_root: str, first: str, second: str, query: str) -> DataFrame:
    """U1 by run id: the rows of a report (``q1``, ``q2`` or ``q3``) that only one of two stored runs has."""
    return diff_runs(run_report(spark, store_root, first)[query], run_report(spark, store_root, second)[query])
