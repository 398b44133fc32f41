"""Plan shape: the properties that keep the queries cheap at scale."""

from __future__ import annotations

from fixtures import SHOP_LOG, write_file

from tallylog.operators import aggregates as A
from tallylog.operators import parse as P
from tallylog.plans import catalog
from tallylog.sources import ordinals as O
from tallylog.sources import text as T

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pattern_runs_once_per_line(spark):
    plan = _optimized(A.q1_daily_traffic(catalog.parsed(spark, SF)))
    # one rewrite for the match; the per-group path only for strings holding a line feed
    assert plan.count("regexp_replace(") == 1
    # the validity filter sits above the generator and reads a plain column
    filter_line = next(line for line in plan.splitlines() if "Filter" in line)
    assert "regexp" not in filter_line and "gettimestamp" not in filter_line


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(A.q1_daily_traffic(catalog.parsed(spark, SF)))
    schema = next(line for line in plan.splitlines() if "ReadSchema" in line or "FileScan" in line)
    assert "props" not in schema and "event_id" in schema


def test_top_k_before_rank_window(spark):
    plan = _plan(A.q2_top_resources(catalog.parsed(spark, SF)))
    assert "TakeOrderedAndProject(limit=20" in plan
    lines = plan.splitlines()
    window_at = next(i for i, line in enumerate(lines) if "Window [" in line)
    take_at = next(i for i, line in enumerate(lines) if "TakeOrderedAndProject" in line)
    assert window_at < take_at  # the window's input is the 20-row top k


def test_distinct_counts_shuffle_on_key_and_host_first(spark):
    plan = _plan(A.q2_top_resources(catalog.parsed(spark, SF)))
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("resource_path" in e and "host" in e for e in exchanges)
    assert "partial_count(distinct" in plan


def test_only_the_fields_asked_for_are_parsed(spark):
    for query in (catalog.q1_daily_traffic, catalog.run_stats, catalog.total_records, catalog.count_malformed):
        plan = _optimized(query(spark, SF))
        assert "regexp_extract_all" not in plan, query.__name__
        assert plan.count("regexp_replace(") == 1, query.__name__


def test_staged_queries_parse_nothing_again(spark):
    for query in (catalog.q2_top_resources, catalog.join_top_paths_hosts, catalog.join_hourly_three_way, catalog.merge_hourly_left):
        assert "regexp_replace(" not in _optimized(query(spark, SF)), query.__name__


def test_pairs_of_other_paths_go_before_hosts_are_compared(spark):
    plan = _optimized(catalog.join_top_paths_hosts(spark, SF))
    lines = plan.splitlines()
    semi = max(i for i, line in enumerate(lines) if "Join LeftSemi" in line)
    distinct = min(i for i, line in enumerate(lines) if "count(distinct" in line or "Aggregate [resource_path" in line and "host" in line)
    assert distinct < semi  # the aggregate stands above the join


def test_no_python_in_the_parse(spark):
    plan = _plan(P.flag_lines(catalog.lines(spark, SF)))
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_reading_a_run_prunes_to_its_partition(spark, new_dir):
    from tallylog.plans.job import run_report_job
    from tallylog.sources import store as S
    folder = new_dir("plan-store-in")
    write_file(folder, "NASA_access_log_Jul95", SHOP_LOG)
    store_root = new_dir("plan-store")
    run_id = run_report_job(spark, folder, store_root, batch_size=10)
    q1 = S.read_run_results(spark, store_root, run_id)["q1"]
    plan = _plan(q1)
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "PartitionFilters: [isnotnull(run_id" in scan and run_id in scan


def test_parse_to_partial_aggregate_is_one_codegen_stage(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # to read the codegen stage ids
    try:
        plan = _plan(A.q1_daily_traffic(catalog.parsed(spark, SF)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    # operator lines only (the capture template holds line feeds of its own)
    ops = [line.strip().removeprefix("+- ") for line in plan.splitlines()
           if line.strip().startswith(("+- ", "*(")) or line.startswith("*(")]
    start = next(i for i, op in enumerate(ops) if "partial_count" in op)
    end = next(i for i, op in enumerate(ops) if "ColumnarToRow" in op)
    stages = {op.split(")")[0] for op in ops[start:end]}
    assert stages == {"*(2"} or (len(stages) == 1 and next(iter(stages)).startswith("*("))
    assert any("Generate" in op for op in ops[start:end])


def test_hourly_tables_come_from_one_scan_and_one_aggregate(spark, monkeypatch):
    from tallylog.sources import store as S
    plans = []
    write = S.materialize_parsed
    monkeypatch.setattr(S, "materialize_parsed", lambda df, path: plans.append(_plan(df)) or write(df, path))
    for query in (catalog.join_hourly_three_way, catalog.merge_hourly_left):
        plans.clear()
        joined = _plan(query(spark, SF))
        assert len(plans) == 1 and plans[0].count("FileScan") == 1  # one table, an hour a row, from one scan of the log
        exchanges = [line for line in plans[0].splitlines() if "Exchange hashpartitioning" in line]
        assert len(exchanges) == 2 and "host" in exchanges[1] and "host" not in exchanges[0]  # records by hour and host, then hours
        assert "host)" not in joined and "regexp" not in joined
