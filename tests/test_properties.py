"""Properties on the events-derived log (sf0.001): ordinals, merges, totals."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallylog.operators import batches as B
from tallylog.operators import parse as P
from tallylog.plans import reports as R
from tallylog.sources import ordinals as O
from tallylog.sources import text as T
from tallylog.sources.eventlog import DAY_PREFIX, event_log_lines, write_event_log

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def log_root(spark):
    return write_event_log(spark, SF)


@pytest.fixture(scope="module")
def expected_lines(spark):
    return sorted(tuple(r) for r in event_log_lines(spark, SF).collect())


@pytest.mark.parametrize("split_bytes", [512, 2048, 100_000, 128 * 1024 * 1024])
def test_ordinals_exact_under_any_split_size(spark, log_root, expected_lines, split_bytes):
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], str(split_bytes))
        spark.conf.set(keys[1], str(min(split_bytes, 4 * 1024 * 1024)))
        lines, files = T.read_log_lines(spark, log_root, DAY_PREFIX)
        got = sorted(tuple(r) for r in O.assign_ordinal(lines).select("ordinal", "raw").collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == expected_lines
    assert len(files) >= 30  # a part file or more in each day's entry


def test_gzip_copy_numbers_the_same(spark, expected_lines):
    root = write_event_log(spark, SF, compression="gzip")
    lines, files = T.read_log_lines(spark, root, DAY_PREFIX)
    assert all(f.path.endswith(".gz") for f in files)
    got = sorted(tuple(r) for r in O.assign_ordinal(lines).select("ordinal", "raw").collect())
    assert got == expected_lines


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("n", [1, 7, 1000, 10**9])
def test_merged_partials_equal_direct(spark, n):
    parsed = P.parse_access_log(event_log_lines(spark, SF), batch_size=n)
    direct, staged = R.direct_reports(parsed), R.staged_reports(parsed)
    for q in ("q1", "q2", "q3"):
        cols = direct[q].columns
        assert _rows(direct[q]) == _rows(staged[q].select(*cols)), q


def test_totals_add_up(spark):
    flagged = P.flag_lines(event_log_lines(spark, SF), 100)
    stats = B.run_stats(flagged).first()
    assert stats["total_records"] + stats["malformed_count"] == 1000
    summary = B.batch_summary(flagged).agg(F.sum("record_count"), F.sum("malformed_count")).first()
    assert tuple(summary) == (stats["total_records"], stats["malformed_count"])
    assert stats["num_batches"] == 10


def test_ordinals_survive_a_change_in_live_cores(spark, log_root, expected_lines):
    """Executors lost or added after the scan change the parallelism that Spark sizes
    file splits from; the numbering must not depend on it, nor change the session."""
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    try:
        lines, _ = T.read_log_lines(spark, log_root, DAY_PREFIX)
        numbered = O.assign_ordinal(lines)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "3")
        got = sorted(tuple(r) for r in numbered.select("ordinal", "raw").collect())
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert got == expected_lines
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) == before


def test_ordinals_over_many_blocks_of_files(spark, log_root, expected_lines, monkeypatch):
    monkeypatch.setattr(O, "FILES_IN_BLOCK", 4)
    lines, _ = T.read_log_lines(spark, log_root, DAY_PREFIX)
    assert sorted(tuple(r) for r in O.assign_ordinal(lines).select("ordinal", "raw").collect()) == expected_lines


def test_job_numbers_lines_from_one_scan(spark, log_root, new_dir):
    from tallylog.plans.job import run_report_job
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        store_root = new_dir("job-store")
        run_id = run_report_job(spark, log_root, store_root, batch_size=100, name_prefix=DAY_PREFIX,
                                keep_staging=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    kept = spark.read.parquet(f"{store_root}/staging/{run_id}/flagged")
    cols = ["ordinal", "batch_id", "is_valid", "host", "status_code"]
    want = P.flag_lines(event_log_lines(spark, SF), 100).select(*cols)
    assert _rows(kept.select(*cols)) == _rows(want)


@pytest.mark.parametrize("n", [1, 7, 100, 10**9])
def test_line_batch_stats_from_split_table_equal_run_stats(spark, log_root, n):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        files = T.list_inputs(spark, log_root, DAY_PREFIX)
        flagged = P.flag_lines(T.scan_spread(spark, files))
        offsets = O.write_split_table(flagged, T.files_frame(spark, files))
        got = O.line_batch_stats(offsets, n).first()
        by_file = O.file_batch_stats(offsets).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = B.run_stats(P.flag_lines(event_log_lines(spark, SF), n)).first()
    assert got.asDict() == want.asDict()
    tagged, _ = T.read_log_lines(spark, log_root, DAY_PREFIX)
    assert by_file.asDict() == B.run_stats(P.flag_lines(tagged)).first().asDict()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_gzip_file_has_no_hot_join_key(spark, new_dir, monkeypatch):
    from fixtures import write_file
    folder = new_dir("gz")
    body = [f"line {i}" for i in range(5000)]
    write_file(folder, "NASA_access_log_Jul95.gz", body[:4000])
    write_file(folder, "NASA_access_log_Aug95", body[4000:])
    monkeypatch.setattr(O, "ROWS_IN_BLOCK", 256)
    lines, _ = T.read_log_lines(spark, folder)
    numbered, offsets = O.number_lines(lines)
    sizes = [r.n_lines for r in offsets.collect()]
    assert max(sizes) <= 256 and len(sizes) >= 20 and sum(sizes) == 5000
    assert offsets.groupBy(*O.BLOCK_KEYS).count().filter("count > 1").count() == 0
    got = sorted(tuple(r) for r in numbered.select("ordinal", "raw").collect())
    assert got == [(i + 1, x) for i, x in enumerate(body)]


def test_numbering_does_not_write_the_lines(spark, log_root, new_dir, monkeypatch):
    import os
    folder = new_dir("numbering")
    monkeypatch.setattr(O, "staging_path", lambda spark, name: f"{folder}/{name}")
    lines, _ = T.read_log_lines(spark, log_root, DAY_PREFIX)
    numbered, offsets = O.number_lines(lines)
    assert numbered.count() == 1000
    assert os.listdir(folder) == ["split-offsets"] and "raw" not in offsets.columns
    scan = next(x for x in _plan(lines.groupBy("file_path").count()).splitlines() if "FileScan text" in x)
    assert "value" not in scan.split("ReadSchema")[1]  # counting reads no text column


def test_ordinals_survive_a_change_of_cores_between_the_two_scans(spark, log_root, expected_lines):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "256")
        lines, _ = T.read_log_lines(spark, log_root, DAY_PREFIX)
        before = lines.select("raw").rdd.getNumPartitions()
        numbered, _ = O.number_lines(lines)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "61")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        got = sorted(tuple(r) for r in numbered.select("ordinal", "raw").collect())
        unpinned = T.scan_lines(spark, T.list_inputs(spark, log_root, DAY_PREFIX)).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert got == expected_lines and unpinned > 2 * before


def test_input_that_changes_while_it_is_numbered_is_an_error(spark, new_dir):
    from fixtures import write_file
    folder = new_dir("changing")
    path = write_file(folder, "NASA_access_log_Jul95", ["a", "b"])
    lines, _ = T.read_log_lines(spark, folder)
    numbered = O.assign_ordinal(lines)
    assert sorted(r.ordinal for r in numbered.collect()) == [1, 2]
    with open(path, "w") as f:
        f.write("a\n" * 2 + "c")
    with pytest.raises(Exception, match="has changed"):
        lines, _ = T.read_log_lines(spark, folder)
        O.number_with(lines, O.write_split_table(lines.limit(1))).collect()
