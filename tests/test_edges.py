
from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from fixtures import clf, get, lines_df, write_file
from pyspark.sql import functions as F

from tallylog.operators import aggregates as A
from tallylog.operators import batches as B
from tallylog.operators import parse as P
from tallylog.plans.job import run_report, run_report_job
from tallylog.sources import ordinals as O
from tallylog.sources import store as S
from tallylog.sources import text as T


def _flag(spark, lines, n=None):
    return P.flag_lines(lines_df(spark, lines), n)


def _line(i=0, request=None, status="200", nbytes="10", host=None, clock="00:00:00", day="01"):
    return clf(host or f"h{i}", day, clock, request if request is not None else get(f"/p{i}"), status, nbytes)


def test_d1_jul_before_aug(spark, new_dir):
    folder = new_dir("d1")
    write_file(folder, "NASA_access_log_Aug95", ["aug1", "aug2"])
    write_file(folder, "NASA_access_log_Jul95", ["jul1", "jul2", "jul3"])
    files = T.list_inputs(spark, folder)
    assert [f.entry for f in files] == ["NASA_access_log_Jul95", "NASA_access_log_Aug95"]
    lines, _ = T.read_log_lines(spark, folder)
    got = [tuple(r) for r in O.assign_ordinal(lines).select("ordinal", "raw").orderBy("ordinal").collect()]
    assert got == [(1, "jul1"), (2, "jul2"), (3, "jul3"), (4, "aug1"), (5, "aug2")]
    # file batches follow the same order
    batches = {r["raw"]: r["batch_id"] for r in O.batch_by_file(lines).collect()}
    assert batches["jul1"] == 1 and batches["aug2"] == 2


def test_d1_explicit_list_keeps_caller_order(spark, new_dir):
    folder = new_dir("d1b")
    a = write_file(folder, "NASA_access_log_Jul95", ["jul"])
    b = write_file(folder, "NASA_access_log_Aug95", ["aug"])
    files = T.list_inputs(spark, [b, a])
    assert [f.entry for f in files] == ["NASA_access_log_Aug95", "NASA_access_log_Jul95"]
    assert [f.entry_index for f in files] == [1, 2]


@pytest.mark.parametrize("request_text", ["GET", "   ", ""])
def test_d2_short_request_valid_null_path_not_in_q2(spark, request_text):
    lines = [_line(0, request=request_text), _line(1)]
    f = _flag(spark, lines)
    r = f.orderBy("ordinal").first()
    assert r["is_valid"] and r["resource_path"] is None
    assert r["http_method"] == ("GET" if request_text == "GET" else None)
    paths = [x["resource_path"] for x in A.q2_top_resources(P.filter_valid(f)).collect()]
    assert paths == ["/p1"]


def test_d3_whitespace_split(spark):
    r = _flag(spark, [_line(request=" GET\t/x  HTTP/1.0 extra")]).first()
    assert (r["http_method"], r["resource_path"], r["protocol_version"]) == ("GET", "/x", "HTTP/1.0")


@pytest.mark.parametrize("stamp", ["xx", "01/Xxx/1995:00:00:00 -0400", "31/Feb/1995:00:00:00 -0400",
                                   "01/Jul/1995:25:00:00 -0400", "01/Jul/1995:ab:00:00 -0400", "01/jul/1995:00:00:00 -0400",
                                   "01/Jan/0000:00:00:00 -0400"])
def test_d4_unreadable_time_is_malformed(spark, stamp):
    line = f'h - - [{stamp}] "GET /a HTTP/1.0" 200 1'
    f = _flag(spark, [line, _line(1)])
    assert P.count_malformed(f).first()[0] == 1
    assert B.run_stats(f).first()["total_records"] == 1


def test_d5_status_dash_counted(spark):
    f = _flag(spark, [_line(0, status="-"), _line(1)])
    stats = B.run_stats(f).first()
    assert (stats["total_records"], stats["malformed_count"]) == (1, 1)


@pytest.mark.parametrize("errors,expected", [(1, "0.007812"), (3, "0.023438"), (2, "0.015625"), (5, "0.039062")])
def test_d6_half_even_rate(spark, errors, expected):
    lines = [_line(i, status="404" if i < errors else "200") for i in range(128)]
    q3 = A.q3_hourly_errors(P.filter_valid(_flag(spark, lines))).first()
    assert q3["error_rate"] == Decimal(expected)
    assert (q3["error_request_count"], q3["total_request_count"]) == (errors, 128)


def test_d7_last_batch_of_malformed_lines_not_counted(spark):
    lines = [_line(i) for i in range(4)] + ["junk", "junk"]
    stats = B.run_stats(_flag(spark, lines, n=2)).first()
    assert stats["num_batches"] == 2 and stats["avg_batch_size"] == 2.0


def test_d8_only_chosen_query_written(spark, new_dir):
    folder = new_dir("d8")
    write_file(folder, "NASA_access_log_Jul95", [_line(i, status="404" if i == 0 else "200") for i in range(5)])
    store_root = new_dir("store")
    run_id = run_report_job(spark, folder, store_root, query="1")
    rep = run_report(spark, store_root, run_id)
    assert rep["q1"].count() == 2 and rep["q2"].count() == 0 and rep["q3"].count() == 0
    assert rep["runs"].first()["query_name"] == "1" and rep["runs"].first()["batch_size"] == 0
    with pytest.raises(ValueError):
        run_report_job(spark, folder, store_root, query="4")


def test_d9_no_malformed_line(spark):
    stats = B.run_stats(_flag(spark, [_line(0), _line(1)])).collect()
    assert len(stats) == 1 and stats[0]["malformed_count"] == 0


def test_d10_paths_with_bar_stay_apart(spark):
    f = _flag(spark, [_line(0, request="GET /x|1 HTTP/1.0"), _line(1, request="GET /x|2 HTTP/1.0")])
    assert sorted(r["resource_path"] for r in A.q2_top_resources(P.filter_valid(f)).collect()) == ["/x|1", "/x|2"]


def test_d11_tab_inside_request_keeps_line_whole(spark, new_dir):
    folder = new_dir("d11")
    write_file(folder, "NASA_access_log_Jul95", [_line(0, request="GET\t/t HTTP/1.0")])
    lines, _ = T.read_log_lines(spark, folder)
    r = P.flag_lines(lines.withColumn("ordinal", F.lit(1))).first()
    assert r["is_valid"] and r["resource_path"] == "/t" and "\t" in r["raw"]


def test_d12_latin1_byte_kept(spark, new_dir):
    folder = new_dir("d12")
    raw = b'h - - [01/Jul/1995:00:00:00 -0400] "GET /caf\xe9 HTTP/1.0" 200 5\n'
    write_file(folder, "NASA_access_log_Jul95", raw)
    lines, _ = T.read_log_lines(spark, folder)
    r = P.flag_lines(lines.withColumn("ordinal", F.lit(1))).first()
    assert r["resource_path"] == "/café"


def test_d13_gzip_same_as_plain(spark, new_dir):
    body = [_line(i, status="500" if i % 3 == 0 else "200") for i in range(40)] + ["junk"]
    plain, gz = new_dir("plain"), new_dir("gz")
    write_file(plain, "NASA_access_log_Jul95", body)
    write_file(gz, "NASA_access_log_Jul95.gz", body)
    out = []
    for folder in (plain, gz):
        store_root = new_dir("store")
        run_id = run_report_job(spark, folder, store_root, batch_size=7)
        rep = run_report(spark, store_root, run_id)
        out.append(([tuple(r) for r in rep["q3"].collect()],
                    tuple(rep["runs"].select("num_batches", "total_records", "malformed_count").first())))
    assert out[0] == out[1]
    assert out[0][1] == (6, 40, 1)


def test_d14_numeric_batch_order(spark, new_dir):
    assert sorted(["batch_id=10", "batch_id=2", "batch_id=1"], key=T.natural_key) == \
        ["batch_id=1", "batch_id=2", "batch_id=10"]
    assert sorted(["batch_1000.log", "batch_101.log", "batch_999.log"], key=T.natural_key) == \
        ["batch_101.log", "batch_999.log", "batch_1000.log"]
    lines = lines_df(spark, [f"l{i}" for i in range(1, 13)])
    root = O.write_line_batches(lines, 1, new_dir("batches") + "/out")
    again, files = T.read_log_lines(spark, root, "batch_id=")
    assert [f.entry for f in files][:3] == ["batch_id=1", "batch_id=2", "batch_id=3"]
    got = O.assign_ordinal(again).select("ordinal", O.batch_from_file_name().alias("b"), "raw")
    assert sorted(tuple(r) for r in got.collect()) == [(i, i, f"l{i}") for i in range(1, 13)]


def test_d17_huge_bytes_become_zero(spark):
    r = _flag(spark, [_line(0, nbytes="9" * 20)]).first()
    assert r["is_valid"] and r["bytes_transferred"] == 0


def test_d18_cr_and_crlf_end_lines(spark, new_dir):
    folder = new_dir("d18")
    body = (_line(0) + "\r" + _line(1) + "\r\n" + _line(2) + "\n").encode()
    write_file(folder, "NASA_access_log_Jul95", body)
    lines, _ = T.read_log_lines(spark, folder)
    assert O.assign_ordinal(lines).filter(F.col("raw").startswith("h")).count() == 3


def test_java_end_anchor_is_end_of_text(spark):
    # U+0085 is a line terminator for Java's "$"; the rules mean end of text.
    r = _flag(spark, [_line(0) + "\u0085"]).first()
    assert not r["is_valid"]


def test_b4_batch_from_file_name(spark):
    df = spark.createDataFrame(
        [("/x/batch_007.log", 3), ("/x/batch_id=12/part-0.txt", 1), ("/x/other.log", 5), ("/x/other.log", None)],
        "file_path string, file_index int")
    assert [r[0] for r in df.select(O.batch_from_file_name()).collect()] == [7, 12, 5, 1]


def test_b4_query_names_files_beyond_999(spark, monkeypatch):
    from tallylog.plans import catalog
    monkeypatch.setattr(catalog, "BATCH_SIZE", 1)
    got = {r.ordinal: r.batch_id for r in catalog.batch_from_file_name(spark, "/root/testdata/sf0.001").collect()}
    assert got == {i: 7 if i % 3 == 0 else i for i in range(1, 1001)}


def test_s11_query_checks_rows_of_every_report(spark, monkeypatch):
    from oracle_compare import compare, duck
    from tallylog.oracle import ORACLE_SQL
    from tallylog.plans import catalog
    from tallylog.sources import store as S
    roots, check = [], S.check_result_keys
    monkeypatch.setattr(S, "check_result_keys", lambda spark, root: roots.append(root) or check(spark, root))
    ok, said = compare(catalog.check_result_keys(spark, "/root/testdata/sf0.001"), duck("/root/testdata/sf0.001"), ORACLE_SQL["check_result_keys"])
    assert ok, said
    assert all(S.read_table(spark, roots[0], t).count() for t in S.PRIMARY_KEYS)


def test_diff_runs_reports_both_sides(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, v string")
    from tallylog.operators.setops import diff_runs
    got = sorted(tuple(r) for r in diff_runs(a, b).collect())
    assert got == [("only_in_first", 2, "y"), ("only_in_second", 3, "z")]


def test_store_key_checks_find_violations(spark, new_dir):
    store_root = new_dir("store")
    q1 = spark.createDataFrame([(dt.date(1995, 7, 1), 200, 1, 1)] * 2,
                               "log_date date, status_code int, request_count bigint, total_bytes bigint")
    S.write_results({"q1": q1}, store_root, "orphan")
    got = {(r["table_name"], r["violation"]) for r in S.check_result_keys(spark, store_root).collect()}
    assert got == {("q1_daily_traffic", "duplicate_key"), ("q1_daily_traffic", "missing_run")}


def test_special_characters_in_paths_keep_every_line(spark, new_dir):
    # the scan names files URI-encoded; the file table must join on that same form
    folder = new_dir("sp") + "/my logs%20x"
    import os
    os.makedirs(folder)
    write_file(folder, "NASA_access_log_Jul95 copy", ["a", "b"])
    write_file(folder, "NASA_access_log_Aug95#1", ["c"])
    lines, files = T.read_log_lines(spark, folder)
    assert [f.entry for f in files] == ["NASA_access_log_Jul95 copy", "NASA_access_log_Aug95#1"]
    got = sorted(tuple(r) for r in O.assign_ordinal(lines).select("ordinal", "raw").collect())
    assert got == [(1, "a"), (2, "b"), (3, "c")]


def test_keep_staging_writes_numbered_records(spark, new_dir):
    folder = new_dir("keep")
    write_file(folder, "NASA_access_log_Jul95", [_line(i) for i in range(5)] + ["junk"])
    store_root = new_dir("store")
    run_id = run_report_job(spark, folder, store_root, keep_staging=True)
    kept = spark.read.parquet(f"{store_root}/staging/{run_id}/flagged")
    assert sorted(r["ordinal"] for r in kept.collect()) == [1, 2, 3, 4, 5, 6]
    assert kept.filter("is_valid").count() == 5
    q1p = spark.read.parquet(f"{store_root}/staging/{run_id}/q1_partial")
    assert q1p.agg(F.sum("request_count")).first()[0] == 5
    pairs = spark.read.parquet(f"{store_root}/staging/{run_id}/q2_pairs")
    assert pairs.count() == 5


def test_names_with_glob_characters_are_read_as_they_are(spark, new_dir):
    folder = new_dir("glob") + "/in{a,b}*"
    import os
    os.makedirs(folder)
    write_file(folder, "NASA_access_log_[1]", [_line(0)])
    write_file(folder, "NASA_access_log_1", [_line(1), _line(2)])
    store_root = new_dir("store")
    run_id = run_report_job(spark, folder, store_root)
    assert run_report(spark, store_root, run_id)["runs"].first()["total_records"] == 3
    lines, _ = T.read_log_lines(spark, folder)
    assert sorted(r["raw"] for r in lines.collect()) == sorted(_line(i) for i in range(3))


def test_a_file_named_twice_is_read_once(spark, new_dir):
    folder = new_dir("twice")
    one = write_file(folder, "NASA_access_log_Jul95", ["a", "b"])
    write_file(folder, "NASA_access_log_Aug95", ["c", "d"])
    for inputs in ([folder, one], [folder, folder], [one, one]):
        lines, files = T.read_log_lines(spark, inputs)
        want = ["a", "b"] if inputs == [one, one] else ["a", "b", "c", "d"]
        assert sorted(r["raw"] for r in lines.collect()) == want
        assert [f.file_order for f in files] == list(range(1, len(files) + 1))


def test_a_sum_of_bytes_that_does_not_fit_is_the_largest_bigint(spark, new_dir):
    huge = 2**63 - 1
    folder = new_dir("huge")
    write_file(folder, "NASA_access_log_Jul95", [_line(i, nbytes=str(b)) for i, b in enumerate((huge, 1))])
    store_root = new_dir("store")
    rep = run_report(spark, store_root, run_report_job(spark, folder, store_root))
    assert [r["total_bytes"] for r in rep["q1"].collect()] == [huge]
    assert rep["batches"].first()["total_bytes"] == huge


def test_batch_ids_beyond_32_bits(spark):
    from tallylog.functions.clf import batch_by_lines
    df = spark.createDataFrame([(10**12,)], "ordinal long")
    assert df.select(batch_by_lines("ordinal", 1)).first()[0] == 10**12


def test_every_row_of_a_long_report_is_printed(spark, new_dir, capsys):
    from tallylog.__main__ import main
    folder, store_root = new_dir("long"), new_dir("store")
    days = [f"{d:02d}/{m}/{y}" for y in range(1970, 1986) for m in ("Jan", "Mar", "May") for d in range(1, 11)]
    body = [f'h - - [{day}:{h:02d}:00:00 +0000] "GET /x HTTP/1.0" 404 1' for day in days for h in range(24)]
    write_file(folder, "NASA_access_log_x", body)
    assert len(body) > 10_000
    run_id = run_report_job(spark, folder, store_root, query="3")
    main(["report", "--store", store_root, "--run-id", run_id])
    assert capsys.readouterr().out.count("1.000000") == len(body)


def test_large_gzip_is_spread_and_numbered_the_same(spark, new_dir):
    body = [_line(i, status="404" if i % 5 == 0 else "200") for i in range(3000)]
    plain, gz = new_dir("plain"), new_dir("gz")
    write_file(plain, "NASA_access_log_Jul95", body)
    write_file(gz, "NASA_access_log_Jul95.gz", body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        g_lines, _ = T.read_log_lines(spark, gz)
        p_lines, _ = T.read_log_lines(spark, plain)
        assert g_lines.rdd.getNumPartitions() > 1  # one gzip split, parsed on many tasks
        got = [sorted(tuple(r) for r in O.assign_ordinal(x).select("ordinal", "raw").collect())
               for x in (g_lines, p_lines)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got[0] == got[1] == [(i + 1, body[i]) for i in range(3000)]


def test_line_batches_chunked_when_batch_is_large(spark, new_dir):
    lines = lines_df(spark, [f"l{i}" for i in range(1, 24)])
    root = O.write_line_batches(lines, 10, new_dir("chunks") + "/out", chunk_lines=4)
    again, files = T.read_log_lines(spark, root, "batch_id=")
    assert [f.entry for f in files][:2] == ["batch_id=1", "batch_id=1"]  # chunks of batch 1
    got = O.assign_ordinal(again).select("ordinal", O.batch_from_file_name().alias("b"), "raw")
    assert sorted(tuple(r) for r in got.collect()) == [(i, (i - 1) // 10 + 1, f"l{i}") for i in range(1, 24)]


def test_q2_forms_when_no_line_has_a_path(spark):
    from tallylog.plans import reports as R
    parsed = P.filter_valid(_flag(spark, [_line(i, request="GET") for i in range(3)]))
    assert R.direct_reports(parsed, "2")["q2"].count() == 0


def test_large_gzip_next_to_plain_files_only_moves_gzip_lines(spark, new_dir):
    body = [_line(i, status="404" if i % 5 == 0 else "200") for i in range(3000)]
    folder = new_dir("mixed")
    write_file(folder, "NASA_access_log_Jul95.gz", body[:1500])
    write_file(folder, "NASA_access_log_Aug95", body[1500:])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        lines, _ = T.read_log_lines(spark, folder)
        got = sorted(tuple(r) for r in O.assign_ordinal(lines).select("ordinal", "raw").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [(i + 1, body[i]) for i in range(3000)]


def test_relative_input_folder_keeps_the_prefix_rule(spark, new_dir, monkeypatch):
    folder = new_dir("rel")
    write_file(folder, "NASA_access_log_Jul95", ["a"])
    write_file(folder, "notes.txt", ["b"])
    import os
    monkeypatch.chdir(os.path.dirname(folder))
    files = T.list_inputs(spark, os.path.basename(folder))
    assert [f.entry for f in files] == ["NASA_access_log_Jul95"]


def test_single_file_input_taken_whatever_its_name(spark, new_dir):
    path = write_file(new_dir("single"), "access.log", ["x", "y"])
    files = T.list_inputs(spark, path)
    assert [(f.entry, f.entry_index, f.file_order) for f in files] == [("access.log", 1, 1)]
    lines, _ = T.read_log_lines(spark, path)
    assert sorted(r["raw"] for r in lines.collect()) == ["x", "y"]


def test_job_with_no_paths_writes_an_empty_q2(spark, new_dir):
    folder = new_dir("nopath")
    write_file(folder, "NASA_access_log_Jul95", [_line(i, request="GET", status="404" if i == 0 else "200")
                                                 for i in range(4)])
    store_root = new_dir("store")
    run_id = run_report_job(spark, folder, store_root, batch_size=2)
    rep = run_report(spark, store_root, run_id)
    assert rep["q2"].count() == 0
    assert rep["q1"].count() == 2 and rep["q3"].count() == 1
    assert rep["runs"].first()["num_batches"] == 2
