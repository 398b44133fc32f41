"""The spark-submit entry point (run and report) on a small log."""

from __future__ import annotations

from fixtures import SHOP_LOG, write_file

from tallylog.__main__ import main


def test_run_then_report(spark, new_dir, capsys):
    folder = new_dir("cli")
    write_file(folder, "NASA_access_log_Jul95", SHOP_LOG)
    store_root = new_dir("store")
    assert main(["run", "--input", folder, "--store", store_root, "--batch-size", "10", "--query", "3"]) == 0
    run_id = capsys.readouterr().out.strip().splitlines()[-1]
    assert main(["report", "--store", store_root, "--run-id", run_id]) == 0
    out = capsys.readouterr().out
    assert "0.600000" in out and "== q3" in out
    assert "== batches" in out
    assert main(["report", "--store", store_root, "--run-id", "missing"]) == 1
    assert "No run found" in capsys.readouterr().out
