"""The result store: runs, the three report tables, batches, staging.

Layout under one root folder (parquet), one folder for each run and table, so that
runs never write into each other's folders and a reader of one run prunes to its own:

    runs/run_id=.../              one row per completed run
    q1_daily_traffic/run_id=.../  the reports
    q2_top_resources/run_id=.../
    q3_hourly_errors/run_id=.../
    batches/run_id=.../           one row per batch
    started/run_id=.../           one row per run that is under way, or was when it crashed
    staging/<run_id>/...          parsed records; dropped after the run unless kept

A run writes its ``started`` row first, then its report rows, and its ``runs`` row
last; readers only accept runs that have that row (D15), so a crash mid-run leaves no
visible run. What it does leave, ``sweep_crashed_runs`` finds and drops.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylog.sources.text import escape_glob

RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("pipeline", T.StringType(), False),
    T.StructField("query_name", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("started_at", T.TimestampType(), False),
    T.StructField("finished_at", T.TimestampType(), False),
    T.StructField("runtime_ms", T.LongType(), False),
    T.StructField("batch_size", T.IntegerType(), False),
    T.StructField("num_batches", T.LongType(), False),
    T.StructField("avg_batch_size", T.DoubleType(), False),
    T.StructField("total_records", T.LongType(), False),
    T.StructField("malformed_count", T.LongType(), False),
])

RESULT_SCHEMAS = {
    "q1_daily_traffic": T.StructType([
        T.StructField("log_date", T.DateType(), False),
        T.StructField("status_code", T.IntegerType(), False),
        T.StructField("request_count", T.LongType(), False),
        T.StructField("total_bytes", T.LongType(), False),
    ]),
    "q2_top_resources": T.StructType([
        T.StructField("rank", T.IntegerType(), False),
        T.StructField("resource_path", T.StringType(), False),
        T.StructField("request_count", T.LongType(), False),
        T.StructField("total_bytes", T.LongType(), False),
        T.StructField("distinct_host_count", T.LongType(), False),
    ]),
    "q3_hourly_errors": T.StructType([
        T.StructField("log_date", T.DateType(), False),
        T.StructField("log_hour", T.IntegerType(), False),
        T.StructField("error_request_count", T.LongType(), False),
        T.StructField("total_request_count", T.LongType(), False),
        T.StructField("error_rate", T.DecimalType(20, 6), False),
        T.StructField("distinct_error_hosts", T.LongType(), False),
    ]),
    "batches": T.StructType([
        T.StructField("batch_id", T.LongType(), False),
        T.StructField("record_count", T.LongType(), False),
        T.StructField("malformed_count", T.LongType(), False),
        T.StructField("total_bytes", T.LongType(), False),
    ]),
}

STARTED_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("started_at", T.TimestampType(), False),
    T.StructField("keep_staging", T.BooleanType(), False),
])

QUERY_TABLES = {"q1": "q1_daily_traffic", "q2": "q2_top_resources", "q3": "q3_hourly_errors"}
PRIMARY_KEYS = {
    "runs": ["run_id"],
    "q1_daily_traffic": ["run_id", "log_date", "status_code"],
    "q2_top_resources": ["run_id", "rank"],
    "q3_hourly_errors": ["run_id", "log_date", "log_hour"],
    "batches": ["run_id", "batch_id"],
}
REPORT_ORDER = {
    "q1_daily_traffic": ["log_date", "status_code"],
    "q2_top_resources": ["rank"],
    "q3_hourly_errors": ["log_date", "log_hour"],
    "batches": ["batch_id"],
}


def _table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def _schema(table: str) -> T.StructType:
    known = {"runs": RUNS_SCHEMA, "started": STARTED_SCHEMA}
    if table in known:
        return known[table]
    return T.StructType([T.StructField("run_id", T.StringType(), False), *RESULT_SCHEMAS[table].fields])


def _run_folder(root: str, table: str, run_id: str) -> str:
    return f"{_table_path(root, table)}/run_id={run_id}"


def _load(reader: DataFrameReader, path: str, empty: DataFrame) -> DataFrame:
    try:
        return reader.parquet(path)
    except AnalysisException as exc:  # nothing was written there yet
        if exc.getCondition() == "PATH_NOT_FOUND":
            return empty
        raise


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A whole store table; empty (with its schema) when nothing was written yet."""
    schema = _schema(table)
    return _load(spark.read.schema(schema), _table_path(root, table), spark.createDataFrame([], schema))


def read_run(spark: SparkSession, root: str, table: str, run_id: str) -> DataFrame:
    """The rows of one run, with their run_id: only that run's folder is listed, however many
    runs the store holds. Empty when the run wrote none."""
    schema = _schema(table)
    reader = spark.read.schema(schema).option("basePath", _table_path(root, table))
    found = _load(reader, escape_glob(_run_folder(root, table, run_id)), spark.createDataFrame([], schema))
    return found.filter(F.col("run_id") == F.lit(run_id))


def write_results(results: dict[str, DataFrame], root: str, run_id: str) -> None:
    """Write each chosen report (or the batches) of a run to its own folder."""
    for query, df in results.items():
        table = QUERY_TABLES.get(query, query)
        cols = [f.name for f in RESULT_SCHEMAS[table].fields]
        df.select(*cols).write.mode("errorifexists").parquet(_run_folder(root, table, run_id))


def _write_row(spark: SparkSession, root: str, table: str, row: dict) -> None:
    fields = [f for f in _schema(table).fields if f.name != "run_id"]
    df = spark.createDataFrame([tuple(row[f.name] for f in fields)], T.StructType(fields))
    df.write.mode("errorifexists").parquet(_run_folder(root, table, row["run_id"]))


def write_started(spark: SparkSession, root: str, run_id: str, started_at: dt.datetime, keep_staging: bool = False) -> None:
    """The mark of a run under way, before it writes anything else."""
    _write_row(spark, root, "started", {"run_id": run_id, "started_at": started_at, "keep_staging": keep_staging})


def write_run_metadata(spark: SparkSession, root: str, row: dict) -> None:
    """Write the one ``runs`` row of a finished run (written last)."""
    _write_row(spark, root, "runs", row)


class RunNotFound(LookupError):
    pass


def read_run_results(spark: SparkSession, root: str, run_id: str) -> dict[str, DataFrame]:
    """Metadata, the three reports and the batches of one completed run, in report order."""
    runs = read_run(spark, root, "runs", run_id).filter(F.col("status") == F.lit("completed"))
    if runs.isEmpty():
        raise RunNotFound(f"No run found with run_id={run_id}")
    out = {"runs": runs}
    for query, table in (*QUERY_TABLES.items(), ("batches", "batches")):
        df = read_run(spark, root, table, run_id).drop("run_id")
        out[query] = df.orderBy(*REPORT_ORDER[table])
    return out


def check_result_keys(spark: SparkSession, root: str) -> DataFrame:
    """Every key violation in the store; empty when the store is valid.

    Columns: table_name, violation, run_id, detail. Checks: primary keys unique,
    no NULL in any column, and every report row belongs to a ``runs`` row.
    """
    runs = read_table(spark, root, "runs")
    parts = []
    for table, keys in PRIMARY_KEYS.items():
        df = runs if table == "runs" else read_table(spark, root, table)
        dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
               .select(F.lit(table).alias("table_name"), F.lit("duplicate_key").alias("violation"),
                       F.col("run_id"),
                       F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in keys])).alias("detail")))
        parts.append(dup)
        nulls = df.filter(F.greatest(*[F.col(c).isNull().cast("int") for c in df.columns]) == 1).select(
            F.lit(table).alias("table_name"), F.lit("null_value").alias("violation"), F.col("run_id"),
            F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in ("run_id", *[c for c in df.columns if c != "run_id"])])).alias("detail"))
        parts.append(nulls)
        if table != "runs":
            orphans = (df.select("run_id").distinct().join(runs.select("run_id"), "run_id", "left_anti")
                       .select(F.lit(table).alias("table_name"), F.lit("missing_run").alias("violation"),
                               F.col("run_id"), F.lit(None).cast("string").alias("detail")))
            parts.append(orphans)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def materialize_parsed(df: DataFrame, path: str) -> DataFrame:
    """Keep an intermediate for several readers: written as parquet to a shared
    folder and read back, so the lineage is cut and a lost executor costs nothing."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, in whatever file system it is; one that is not there is no error.

    In Spark SQL alone: dropping a database deletes the folder it was created at.
    """
    name = f"dropped_{uuid.uuid4().hex}"
    literal = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{literal}'")
    spark.sql(f"DROP DATABASE {name} CASCADE")


def staging_folder(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/staging/{run_id}"


def finish_run(spark: SparkSession, root: str, run_id: str, keep_staging: bool = False) -> None:
    """Drop the staging of a run that has ended (unless kept), then its mark."""
    if not keep_staging:
        drop_folder(spark, staging_folder(root, run_id))
    drop_folder(spark, _run_folder(root, "started", run_id))


def discard_run(spark: SparkSession, root: str, run_id: str) -> None:
    """Drop all that a run without a ``runs`` row has written, its mark last."""
    for table in PRIMARY_KEYS:
        drop_folder(spark, _run_folder(root, table, run_id))
    finish_run(spark, root, run_id)


def _last_writes(spark: SparkSession, root: str) -> DataFrame:
    """run_id and the time of the newest file of every run with a file in the store (its names and times are listed, nothing is read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    schema = "run_id string, seen_at timestamp"
    parts = []
    for table in [*PRIMARY_KEYS, "staging"]:
        try:
            listed = files.load(escape_glob(_table_path(root, table))).select("path", "modificationTime")
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        pattern = f"/{table}/([^/]+)/" if table == "staging" else f"/{table}/run_id=([^/]+)/"
        parts.append(listed.select(F.regexp_extract("path", pattern, 1).alias("run_id"), F.col("modificationTime").alias("seen_at")))
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], schema)).filter(F.col("run_id") != "")


def find_crashed_runs(spark: SparkSession, root: str, older_than: dt.timedelta, now: dt.datetime | None = None) -> DataFrame:
    """Runs that left something behind: run_id, is_complete, keep_staging.

    A run without a ``runs`` row has crashed if neither its start nor any of its files is
    newer than ``older_than``: it may be a run in progress before that. A complete run is
    found when it ended before it could clean up (its mark is still there).
    """
    before = (now or dt.datetime.now(dt.timezone.utc)) - older_than
    marks = read_table(spark, root, "started")
    seen = (_last_writes(spark, root).unionByName(marks.select("run_id", F.col("started_at").alias("seen_at")))
            .groupBy("run_id").agg(F.max("seen_at").alias("seen_at")).filter(F.col("seen_at") < F.lit(before)))
    complete = read_table(spark, root, "runs").select("run_id").distinct().withColumn("is_complete", F.lit(True))
    return (seen.join(complete, "run_id", "left").join(marks.select("run_id", "keep_staging"), "run_id", "left")
            .filter(F.col("is_complete").isNull() | F.col("keep_staging").isNotNull())
            .select("run_id", F.coalesce("is_complete", F.lit(False)).alias("is_complete"), F.coalesce("keep_staging", F.lit(False)).alias("keep_staging")))


def sweep_crashed_runs(spark: SparkSession, root: str, older_than: dt.timedelta, now: dt.datetime | None = None) -> list[str]:
    """Drop what crashed runs left in the store, and return their run_ids.

    Of a run without a ``runs`` row that goes are its folders in all tables and in staging;
    of a complete one only staging that it was not to keep. The mark goes last, so a
    sweep that is itself interrupted is taken up again by the next.
    """
    crashed = find_crashed_runs(spark, root, older_than, now).orderBy("run_id").collect()  # a row a crash
    for run in crashed:
        if run.is_complete:
            finish_run(spark, root, run.run_id, run.keep_staging)
        else:
            discard_run(spark, root, run.run_id)
    return [run.run_id for run in crashed]
