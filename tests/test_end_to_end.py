"""A small log end to end (14 lines, N = 10), in direct and staged form and through the job."""

from __future__ import annotations

import datetime as dt
import glob
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from fixtures import SHOP_LOG, lines_df, write_file

from tallylog.operators import aggregates as A
from tallylog.operators import batches as B
from tallylog.operators import parse as P
from tallylog.plans import reports as R
from tallylog.plans.job import diff_stored_runs, run_report, run_report_job
from tallylog.sources import store as S

D3, D4, D5 = dt.date(1999, 3, 3), dt.date(1999, 3, 4), dt.date(1999, 3, 5)

Q1_EXPECTED = {
    (D3, 200): (3, 2440), (D3, 304): (1, 0), (D3, 404): (1, 310), (D3, 503): (1, 80),
    (D4, 200): (2, 1307), (D4, 404): (2, 20), (D4, 500): (1, 90), (D5, 200): (1, 310),
}
Q2_EXPECTED = [(1, "/cart", 5, 230, 3), (2, "/home", 4, 3700, 4), (3, "/help", 2, 620, 2)]
Q3_EXPECTED = [
    (D3, 5, 1, 3, Decimal("0.333333"), 1),
    (D3, 6, 1, 3, Decimal("0.333333"), 1),
    (D4, 23, 3, 5, Decimal("0.600000"), 2),
]
BATCHES_EXPECTED = [(1, 9, 1, 4230), (2, 3, 1, 327)]


@pytest.fixture(scope="module")
def flagged(spark):
    return P.flag_lines(lines_df(spark, SHOP_LOG), batch_size=10).cache()


@pytest.fixture(scope="module")
def parsed(flagged):
    return P.project_parsed(P.filter_valid(flagged))


def _q1(df):
    return {(r["log_date"], r["status_code"]): (r["request_count"], r["total_bytes"]) for r in df.collect()}


def _q2(df):
    return [tuple(r) for r in df.select(
        "rank", "resource_path", "request_count", "total_bytes", "distinct_host_count").collect()]


def _q3(df):
    return [tuple(r) for r in df.select(*A.Q3_COLUMNS).collect()]


def test_run_stats(flagged):
    r = B.run_stats(flagged).first()
    assert (r["total_records"], r["malformed_count"], r["num_batches"]) == (12, 2, 2)
    assert r["avg_batch_size"] == pytest.approx(6.0)


@pytest.mark.parametrize("form", ["direct", "staged"])
def test_reports(parsed, form):
    build = {"direct": R.direct_reports, "staged": R.staged_reports}[form]
    reps = build(parsed)
    assert _q1(reps["q1"]) == Q1_EXPECTED
    assert sorted(_q2(reps["q2"])) == Q2_EXPECTED
    assert sorted(_q3(reps["q3"])) == Q3_EXPECTED


def test_sorts_return_their_order(parsed):
    from tallylog.operators import ranking as W
    mixed = parsed.repartition(7, "host", "ordinal")
    q1, q2, q3 = W.sort_q1(A.q1_daily_traffic(mixed)), W.sort_q2_by_rank(A.q2_top_resources(mixed)), W.sort_q3(A.q3_hourly_errors(mixed))
    assert [(r["log_date"], r["status_code"]) for r in q1.collect()] == sorted(Q1_EXPECTED)
    assert _q2(q2) == Q2_EXPECTED and _q3(q3) == Q3_EXPECTED


def test_q3_three_way_and_left_merges_agree(parsed):
    from tallylog.operators import joins as J
    e, h, t = A.errors_by_hour(parsed), A.distinct_error_hosts_by_hour(parsed), A.totals_by_hour(parsed)
    assert sorted(_q3(J.join_hourly_three_way(e, h, t))) == Q3_EXPECTED
    assert sorted(_q3(J.merge_hourly_left(e, h, t))) == Q3_EXPECTED
    unknown = _q3(J.merge_hourly_left(e, h.filter("log_hour = 5"), t.filter("log_hour = 6")))
    assert sorted(unknown) == [(D3, 5, 1, 0, Decimal(0), 1), (D3, 6, 1, 3, Decimal("0.333333"), 0), (D4, 23, 3, 0, Decimal(0), 0)]


def test_rank_forms_agree(parsed):
    from tallylog.operators import ranking as W
    totals = A.path_metrics(parsed, with_hosts=False)
    by_row = W.rank_by_position(W.top_k_paths(totals)).select("rank", "resource_path").collect()
    by_dense = W.dense_rank_paths(totals).select("rank", "resource_path").collect()
    assert sorted(map(tuple, by_row)) == sorted(map(tuple, by_dense))


def test_job_from_file_with_store(spark, new_dir):
    folder = new_dir("in")
    write_file(folder, "NASA_access_log_Jul95", SHOP_LOG)
    store_root = new_dir("store")
    run_id = run_report_job(spark, folder, store_root, batch_size=10)
    rep = run_report(spark, store_root, run_id)
    meta = rep["runs"].first()
    assert (meta["total_records"], meta["malformed_count"], meta["num_batches"]) == (12, 2, 2)
    assert meta["avg_batch_size"] == pytest.approx(6.0)
    assert meta["batch_size"] == 10 and meta["status"] == "completed" and meta["query_name"] == "all"
    assert meta["runtime_ms"] >= 0 and meta["finished_at"] >= meta["started_at"]
    assert _q1(rep["q1"]) == Q1_EXPECTED
    assert _q2(rep["q2"]) == Q2_EXPECTED
    assert _q3(rep["q3"]) == Q3_EXPECTED
    assert [tuple(r) for r in rep["batches"].collect()] == BATCHES_EXPECTED
    assert S.check_result_keys(spark, store_root).count() == 0
    assert not glob.glob(f"{store_root}/staging/*")  # dropped


def test_runs_at_once_into_one_store(spark, new_dir):
    folder, store_root = new_dir("in"), new_dir("store")
    write_file(folder, "NASA_access_log_Jul95", SHOP_LOG)
    with ThreadPoolExecutor(8) as pool:
        runs = list(pool.map(lambda i: run_report_job(spark, folder, store_root, batch_size=10), range(8)))
    assert S.read_table(spark, store_root, "runs").count() == 8
    for r in runs[:2]:
        assert _q2(run_report(spark, store_root, r)["q2"]) == Q2_EXPECTED
    assert S.check_result_keys(spark, store_root).count() == 0


def test_unknown_run(spark, new_dir):
    store_root = new_dir("store")
    with pytest.raises(S.RunNotFound, match="No run found"):
        run_report(spark, store_root, "nope")


def test_empty_run_writes_nothing(spark, new_dir):
    folder = new_dir("in")
    write_file(folder, "NASA_access_log_Jul95", ["junk", "more junk"])
    store_root = new_dir("store")
    with pytest.raises(B.EmptyRunError):
        run_report_job(spark, folder, store_root)
    assert S.read_table(spark, store_root, "runs").count() == 0
    assert S.read_table(spark, store_root, "q1_daily_traffic").count() == 0
    assert not glob.glob(f"{store_root}/staging/*")


def test_missing_inputs(spark, new_dir):
    from tallylog.sources.text import list_inputs
    with pytest.raises(FileNotFoundError):
        list_inputs(spark, new_dir("empty") + "/missing")
    folder = new_dir("in")
    write_file(folder, "other.log", SHOP_LOG)
    with pytest.raises(FileNotFoundError):
        list_inputs(spark, folder)


@pytest.mark.parametrize("batch_size", [10, None])
def test_job_that_keeps_staging_gives_the_same_run(spark, new_dir, batch_size):
    folder = new_dir("in")
    write_file(folder, "NASA_access_log_Jul95", SHOP_LOG)
    store_root = new_dir("store")
    run_id = run_report_job(spark, folder, store_root, batch_size=batch_size, keep_staging=True)
    rep = run_report(spark, store_root, run_id)
    meta = rep["runs"].first()
    assert (meta["total_records"], meta["malformed_count"]) == (12, 2)
    assert meta["num_batches"] == (2 if batch_size else 1)
    assert _q1(rep["q1"]) == Q1_EXPECTED and _q2(rep["q2"]) == Q2_EXPECTED and _q3(rep["q3"]) == Q3_EXPECTED
    assert spark.read.parquet(f"{store_root}/staging/{run_id}/parsed").count() == 14


def test_two_runs_in_one_store_agree_both_ways(spark, new_dir):
    from tallylog.operators.setops import diff_runs
    folder = new_dir("in")
    write_file(folder, "NASA_access_log_Jul95", SHOP_LOG[:8])
    write_file(folder, "NASA_access_log_Aug95", SHOP_LOG[8:])
    store_root = new_dir("store")
    by_lines = run_report_job(spark, folder, store_root, batch_size=4)
    by_files = run_report_job(spark, folder, store_root)
    assert diff_stored_runs(spark, store_root, by_lines, by_files, "q2").count() == 0
    a, b = run_report(spark, store_root, by_lines), run_report(spark, store_root, by_files)
    for q in ("q1", "q2", "q3"):
        assert diff_runs(a[q], b[q]).count() == 0, q
    assert a["runs"].first()["num_batches"] == 4 and b["runs"].first()["num_batches"] == 2
    assert S.check_result_keys(spark, store_root).count() == 0
