"""Compare a Spark result with its DuckDB oracle on the same parquet tables."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if v != v:
            return None
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v.quantize(decimal.Decimal("0.000001"))) if v.as_tuple().exponent < 0 else str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duckdb={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} duckdb={len(d_rows)}"
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, first: {diff}"
    return True, f"{len(s_rows)} rows equal"


_SPARK_TO_DUCK = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "smallint": "SMALLINT",
}


def type_mismatches(spark_df, con, sql: str) -> list[str]:
    """Columns whose Spark type and DuckDB type differ."""
    res = con.execute(f"DESCRIBE {sql}").fetchall()
    duck_types = {r[0]: r[1] for r in res}
    out = []
    for name, stype in spark_df.dtypes:
        want = _SPARK_TO_DUCK.get(stype, stype.upper().replace(" ", ""))
        got = duck_types.get(name, "?").replace(" ", "")
        if want != got:
            out.append(f"{name}: spark {stype} vs duckdb {got}")
    return out
