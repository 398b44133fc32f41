"""Run every registered query against its DuckDB oracle and print one line each.

Usage: python tests/run_oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

import __spark_entry__ as E  # noqa: E402
from oracle_compare import compare, duck  # noqa: E402
from tallylog.session import local_session  # noqa: E402


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    for key, fn in qs.items():
        if only and key not in only:
            continue
        t = time.time()
        try:
            ok, msg = compare(fn(spark, sf_dir), con, sql[key]) if key in sql else (True, "no oracle")
        except Exception as exc:  # report and go on
            ok, msg = False, f"error: {type(exc).__name__}: {str(exc)[:300]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {key:32s} {time.time() - t:6.2f}s {msg}", flush=True)
    print(f"{len(qs) - bad if not only else len(only) - bad} ok, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
