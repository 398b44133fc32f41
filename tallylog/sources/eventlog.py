"""An access log derived from the ``events`` table (fixture D of FIXTURES.md).

The given test tables hold no access log, so every registered query builds its
log lines from ``events`` with the rule below; the DuckDB oracle builds the
same text with the same rule (``tallylog.oracle``). The lines then go through
exactly the same parsing and reports as lines read from files.

``write_event_log`` also writes the lines as real text files in the shared
folder (one input entry per calendar day, optionally gzip), so that the file
sources, ordinals and file batches run on data that grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylog.functions.clf import MONTHS
from tallylog.session import staging_path

# Fixed values of the derivation rule (FIXTURES.md, fixture D). Every modulus
# applies to event_id; the first rule that holds wins.
GARBAGE_MOD, GARBAGE_REM = 97, 5
EMPTY_MOD, EMPTY_REM = 211, 7
BARE_METHOD_MOD, BARE_METHOD_REM = 53, 3
BLANK_REQUEST_MOD, BLANK_REQUEST_REM = 59, 4
NO_PROTOCOL_MOD, NO_PROTOCOL_REM = 61, 6
PAGE_MOD = 40
NO_STATUS_MOD, NO_STATUS_REM = 101, 9
SERVER_ERROR_MOD = 3
NOT_MODIFIED_MOD = 11
NO_BYTES_MOD = 7
HOST_SUFFIX = ".example.org"
OFFSET = "-0400"
DAY_PREFIX = "day="


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/events.parquet")


def _ts_text() -> Column:
    """``ts`` as yyyy-MM-dd HH:mm:ss[.f]: the TIMESTAMP_NTZ value's own text, so no
    session time zone (and no daylight-saving gap) is involved."""
    return F.col("ts").cast("string")


def _clf_time() -> Column:
    """dd/MMM/yyyy:HH:mm:ss of ``ts`` (English month abbreviations)."""
    t = _ts_text()
    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.substring(t, 6, 2).cast("int"))
    return F.concat(F.substring(t, 9, 2), F.lit("/"), month, F.lit("/"), F.substring(t, 1, 4),
                    F.lit(":"), F.substring(t, 12, 8))


def _line(e: Column) -> Column:
    event_id = F.col("event_id")
    request = (
        F.when(event_id % BARE_METHOD_MOD == BARE_METHOD_REM, F.lit("GET"))
        .when(event_id % BLANK_REQUEST_MOD == BLANK_REQUEST_REM, F.lit("   "))
        .when(event_id % NO_PROTOCOL_MOD == NO_PROTOCOL_REM, F.concat(F.lit("GET /"), F.col("event_type")))
        .otherwise(F.concat(
            F.lit("GET /"), F.col("event_type"), F.lit("/"),
            (event_id % PAGE_MOD).cast("string"), F.lit(".html HTTP/1.0"),
        ))
    )
    is_error = F.col("event_type") == F.lit("error")
    status = (
        F.when(event_id % NO_STATUS_MOD == NO_STATUS_REM, F.lit("-"))
        .when(is_error & (event_id % SERVER_ERROR_MOD == 0), F.lit("500"))
        .when(is_error, F.lit("404"))
        .when(event_id % NOT_MODIFIED_MOD == 0, F.lit("304"))
        .otherwise(F.lit("200"))
    )
    nbytes = (
        F.when(event_id % NO_BYTES_MOD == 0, F.lit("-"))
        .otherwise(F.floor(F.col("value")).cast("bigint").cast("string"))
    )
    clf = F.concat(
        F.lit("host"), F.col("user_id").cast("string"), F.lit(HOST_SUFFIX),
        F.lit(" - - ["), _clf_time(), F.lit(f" {OFFSET}] \""),
        request, F.lit("\" "), status, F.lit(" "), nbytes,
    )
    return (
        F.when(event_id % GARBAGE_MOD == GARBAGE_REM, F.concat(F.lit("garbage line "), event_id.cast("string")))
        .when(event_id % EMPTY_MOD == EMPTY_REM, F.lit(""))
        .otherwise(clf)
    )


def event_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ordinal BIGINT, raw STRING)``: one log line per event, ordinal = event_id + 1."""
    e = events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "value")
    return e.select(
        (F.col("event_id") + 1).alias("ordinal"),
        _line(e).alias("raw"),
    )


def write_event_log(
    spark: SparkSession,
    sf_dir: str,
    compression: str | None = None,
    copies: int = 1,
) -> str:
    """Write the derived log as text under a fresh folder in the shared folder.

    Layout: ``<root>/day=YYYY-MM-DD/part-*.txt[.gz]``, one entry per calendar day of
    ``events.ts``, lines in ordinal order (``ts`` grows with ``event_id``).
    ``copies``: each line so many times. Returns ``<root>``. Read it back with ``name_prefix="day="``.
    """
    root = staging_path(spark, "eventlog")
    e = events(spark, sf_dir).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    lines = e.select(
        (F.col("event_id") + 1).alias("ordinal"),
        F.substring(_ts_text(), 1, 10).alias("day"),
        _line(e).alias("raw"),
    )
    writer = (
        lines.repartitionByRange("ordinal")
        .sortWithinPartitions("day", "ordinal")
        .select("day", "raw")
        .write.mode("errorifexists")
        .partitionBy("day")
    )
    if compression:
        writer = writer.option("compression", compression)
    writer.text(root)
    return root
