"""The result store: one run read on its own, crashed runs swept, clean-up that fails; differences; key checks that can fail."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from fixtures import SHOP_LOG, write_file
from pyspark.sql import functions as F

from tallylog.__main__ import main
from tallylog.operators.setops import diff_runs
from tallylog.plans import job as K
from tallylog.plans.job import run_report, run_report_job
from tallylog.sources import store as S

UTC = dt.timezone.utc
DAY = dt.timedelta(days=1)
Q1 = "log_date date, status_code int, request_count bigint, total_bytes bigint"


@pytest.fixture()
def shop(new_dir):
    folder = new_dir("in")
    write_file(folder, "NASA_access_log_Jul95", SHOP_LOG)
    return folder


def _q1(spark, n=1):
    return spark.createDataFrame([(dt.date(1995, 7, 1), 200 + i, 1, 1) for i in range(n)], Q1)


def _left(store_root, run_id):
    return [p for p in glob.glob(f"{store_root}/**", recursive=True) if run_id in p]


def test_reading_one_run_lists_one_folder_a_table(spark, shop, new_dir):
    store_root = new_dir("store")
    run_id = run_report_job(spark, shop, store_root, batch_size=10)
    for i in range(1000):  # other runs, whose files cannot even be read
        for table in S.PRIMARY_KEYS:
            folder = f"{store_root}/{table}/run_id=other-{i}"
            os.makedirs(folder)
            with open(f"{folder}/part-0.parquet", "w") as f:
                f.write("no parquet")
    parts = run_report(spark, store_root, run_id)
    for name, df in parts.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
        index = df._jdf.queryExecution().analyzed().collectLeaves().head().relation().location()
        assert scans and index.rootPaths().mkString().endswith(f"/run_id={run_id}"), (name, scans)
        assert df.count() and all(run_id in p and "other-" not in p for p in df.inputFiles()), name


def test_run_ids_with_glob_characters(spark, new_dir):
    store_root = new_dir("store")
    for run_id in ("a*", "ab", "a{b}"):
        S.write_results({"q1": _q1(spark, len(run_id))}, store_root, run_id)
    for run_id in ("a*", "ab", "a{b}"):
        got = S.read_run(spark, store_root, "q1_daily_traffic", run_id).collect()
        assert len(got) == len(run_id) and {r.run_id for r in got} == {run_id}
    assert S.read_run(spark, store_root, "q1_daily_traffic", "a?").count() == 0


class Killed(BaseException):
    """Stands for a driver that is gone: nothing after it runs."""


def test_a_run_killed_between_two_reports_leaves_nothing_after_the_sweep(spark, shop, new_dir, monkeypatch):
    store_root = new_dir("store")
    whole = run_report_job(spark, shop, store_root, batch_size=10)
    kept = run_report_job(spark, shop, store_root, batch_size=10, keep_staging=True)
    before = set(_left(store_root, whole) + _left(store_root, kept))

    def write_some(parsed, batches, query, root, run_id):
        S.write_results({"q1": K.BUILDERS["q1"](parsed)}, root, run_id)
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(K, "write_reports_concurrently", write_some)
        m.setattr(K, "_clean_up", lambda *args: None)
        with pytest.raises(Killed):
            run_report_job(spark, shop, store_root, batch_size=10)
    killed = S.read_table(spark, store_root, "started").first().run_id
    assert S.read_run(spark, store_root, "q1_daily_traffic", killed).count() and glob.glob(f"{store_root}/staging/{killed}/*")
    with pytest.raises(S.RunNotFound):
        run_report(spark, store_root, killed)

    assert S.sweep_crashed_runs(spark, store_root, DAY) == []  # it may be in progress
    assert _left(store_root, killed)
    assert S.sweep_crashed_runs(spark, store_root, dt.timedelta(0)) == [killed]
    assert not _left(store_root, killed)
    assert set(_left(store_root, whole) + _left(store_root, kept)) == before
    assert S.sweep_crashed_runs(spark, store_root, dt.timedelta(0)) == []
    assert S.check_result_keys(spark, store_root).count() == 0


def test_sweep_tells_runs_in_progress_and_finds_runs_without_a_mark(spark, new_dir):
    store_root, now = new_dir("store"), dt.datetime.now(UTC)
    S.write_started(spark, store_root, "early", now - 3 * DAY)        # began long ago and is still writing
    S.write_results({"q1": _q1(spark)}, store_root, "early")
    S.write_started(spark, store_root, "hidden", now - 3 * DAY)       # killed while its first files were not committed
    os.makedirs(f"{store_root}/q2_top_resources/run_id=hidden/_temporary/0")
    os.makedirs(f"{store_root}/staging/hidden/parsed/_temporary/0")
    S.write_started(spark, store_root, "young", now)
    S.write_results({"q3": spark.createDataFrame([], S.RESULT_SCHEMAS["q3_hourly_errors"])}, store_root, "unmarked")
    assert S.sweep_crashed_runs(spark, store_root, DAY, now) == ["hidden"]
    assert not _left(store_root, "hidden") and _left(store_root, "early") and _left(store_root, "unmarked")
    later = now + 2 * DAY
    assert S.sweep_crashed_runs(spark, store_root, DAY, later) == ["early", "unmarked", "young"]
    assert not any(_left(store_root, r) for r in ("early", "unmarked", "young"))
    assert S.sweep_crashed_runs(spark, new_dir("none"), DAY) == []


def test_sweep_of_a_complete_run_that_could_not_clean_up(spark, shop, new_dir, monkeypatch):
    store_root = new_dir("store")

    def fails(*args):
        raise OSError("no clean-up today")

    for keep in (False, True):
        with monkeypatch.context() as m:
            m.setattr(S, "drop_folder", fails)
            with pytest.warns(UserWarning, match="left for a sweep"):
                run_id = run_report_job(spark, shop, store_root, keep_staging=keep)  # the run id comes all the same
        assert run_report(spark, store_root, run_id)["q1"].count()
        assert S.sweep_crashed_runs(spark, store_root, dt.timedelta(0)) == [run_id]
        assert bool(glob.glob(f"{store_root}/staging/{run_id}/*")) == keep
        assert run_report(spark, store_root, run_id)["q1"].count()


def test_a_run_that_fails_drops_what_it_wrote(spark, shop, new_dir, monkeypatch):
    store_root = new_dir("store")
    write = S.write_results

    def second_fails(results, root, run_id):
        if "q2" in results:
            raise RuntimeError("disk full")
        write(results, root, run_id)

    monkeypatch.setattr(S, "write_results", second_fails)
    with pytest.raises(RuntimeError, match="disk full"):
        run_report_job(spark, shop, store_root)
    assert not [p for p in glob.glob(f"{store_root}/**", recursive=True) if os.path.isfile(p)]


def test_drop_folder_of_any_name(spark, new_dir):
    parent = new_dir("drop")
    for name in ("plain", "with space", "it's", "a%20b", "[x]*{y}"):
        folder = f"{parent}/{name}"
        os.makedirs(f"{folder}/deep")
        write_file(f"{folder}/deep", "f", ["x"])
        S.drop_folder(spark, folder)
        assert not os.path.exists(folder), name
        S.drop_folder(spark, folder)
    assert os.listdir(parent) == []


def test_sweep_from_the_command_line(spark, new_dir, capsys):
    store_root = new_dir("store")
    S.write_started(spark, store_root, "gone", dt.datetime.now(UTC) - DAY)
    assert main(["sweep", "--store", store_root, "--older-than-hours", "48"]) == 0
    assert capsys.readouterr().out.strip() == ""
    assert main(["sweep", "--store", store_root, "--older-than-hours", "12"]) == 0
    assert capsys.readouterr().out.strip() == "gone"


# ---------------------------------------------------------------- U1

def test_difference_counts_repeated_rows_nulls_and_odd_names(spark):
    schema = "`a.b` int, side string, n double"
    first = spark.createDataFrame([(1, "x", 0.5)] * 3 + [(None, None, None)] * 2 + [(2, "y", float("nan")), (3, "z", 0.0)], schema)
    second = spark.createDataFrame([(1, "x", 0.5)] + [(None, None, None)] * 3 + [(2, "y", float("nan")), (3, "z", -0.0), (4, "w", 1.0)], schema)
    got = sorted(map(str, (tuple(r) for r in diff_runs(first.drop("side"), second.drop("side").select("n", "`a.b`")).collect())))
    assert got == sorted(map(str, [("only_in_first", 1, 0.5)] * 2 + [("only_in_second", None, None), ("only_in_second", 4, 1.0)]))
    assert diff_runs(first, first).count() == 0
    empty = first.limit(0)
    assert diff_runs(empty, empty).count() == 0 and diff_runs(first, empty).filter("n is null").count() == 2


def test_difference_is_one_exchange(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    plan = diff_runs(a, a)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


# ---------------------------------------------------------------- S11

def test_key_checks_of_every_table(spark, shop, new_dir):
    store_root = new_dir("store")
    good = run_report(spark, store_root, run_report_job(spark, shop, store_root, batch_size=10))
    assert S.check_result_keys(spark, store_root).count() == 0
    for table, keys in S.PRIMARY_KEYS.items():
        query = {v: k for k, v in S.QUERY_TABLES.items()}.get(table, table)
        rows = good[query].drop("run_id").limit(1)
        column = [c for c in rows.columns if c not in keys][0]
        bad = rows.unionByName(rows.withColumn(column, F.lit(None).cast(rows.schema[column].dataType)))
        root = new_dir(f"bad-{table}")
        bad.write.parquet(f"{root}/{table}/run_id=bad")
        got = {(r.table_name, r.violation) for r in S.check_result_keys(spark, root).collect()}
        assert got == {(table, v) for v in ("duplicate_key", "null_value", *(() if table == "runs" else ("missing_run",)))}, table
