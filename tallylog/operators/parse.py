"""Parse raw lines into typed records.

``flag_lines`` evaluates the pattern once per line and keeps every line, valid
or not, with an ``is_valid`` flag; the parsed records and the malformed count
are both read from that one DataFrame, so the pattern never runs twice.

Once per line also holds inside one plan: Catalyst pushes a filter below a
projection by copying the projected expressions into the filter, which for the
parse would run the pattern and the date parser again for every reference (and
made the generated code several times larger). The parsed columns therefore
come out of a one-row generator (``inline`` of a one-element array), which no
filter is pushed through; each line is parsed exactly once, in codegen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylog.functions import clf

PARSED_COLUMNS = [
    "ordinal", "batch_id", "host", "timestamp_raw", "log_date", "log_hour",
    "http_method", "resource_path", "protocol_version", "status_code", "bytes_transferred",
]

# The record fields the parsed data set publishes (ordinal and batch aside).
RECORD_COLUMNS = [
    "host", "timestamp_raw", "log_date", "log_hour", "http_method",
    "resource_path", "protocol_version", "status_code", "bytes_transferred",
]


FIELD_COLUMNS = ["host", "timestamp_raw", "request_raw", "status_raw", "bytes_raw"]


def extract_log_fields(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """The five captures of the master pattern ('' where the line does not match)."""
    with_parts = lines.withColumn("_parts", clf.log_parts(raw))
    matched = clf.is_match("_parts")
    return with_parts.withColumns({
        name: F.when(matched, F.col("_parts")[i]).otherwise(F.lit(""))
        for i, name in enumerate(FIELD_COLUMNS)
    }).drop("_parts")


def derive_fields(fields: DataFrame) -> DataFrame:
    """P4-P8 on top of P1: date, hour, request tokens, bytes, status, and the validity flag."""
    tokens = clf.request_tokens("request_raw")
    return (
        fields.withColumns({
            "log_date": clf.log_date("timestamp_raw"),
            "log_hour": clf.log_hour("timestamp_raw"),
            "_tokens": tokens,
        })
        .withColumns({
            "is_valid": clf.is_valid_line("status_raw", "log_date", "log_hour"),
            "http_method": clf.request_token(F.col("_tokens"), 1),
            "resource_path": clf.request_token(F.col("_tokens"), 2),
            "protocol_version": clf.request_token(F.col("_tokens"), 3),
            "status_code": clf.status_code("status_raw"),
            "bytes_transferred": clf.bytes_transferred("bytes_raw"),
        })
        .drop("_tokens")
    )


#: The fields that flag_lines derives.
DERIVED_COLUMNS = [*FIELD_COLUMNS, "log_date", "log_hour", "is_valid", "http_method", "resource_path",
                   "protocol_version", "status_code", "bytes_transferred"]


def with_batch_id(lines: DataFrame, batch_size: int | None) -> DataFrame:
    """B2 when a batch size is given; otherwise B3 (the input file's index, 1 if unknown)."""
    if batch_size is not None:
        return lines.withColumn("batch_id", clf.batch_by_lines("ordinal", batch_size))
    if "file_index" in lines.columns:
        return lines.withColumn("batch_id", F.col("file_index").cast("bigint"))
    return lines.withColumn("batch_id", F.lit(1).cast("bigint"))


def evaluate_once(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pass ``columns`` through a one-row generator so that later filters cannot
    copy their expressions; every other column passes through unchanged."""
    keep = [c for c in df.columns if c not in columns]
    record = F.struct(*[F.col(c) for c in columns])
    return df.select(*keep, F.inline(F.array(record)))


def flag_lines(lines: DataFrame, batch_size: int | None = None, raw: str = "raw",
               columns: list[str] | None = None) -> DataFrame:
    """Every input line with its parsed fields, ``batch_id`` and ``is_valid``.

    ``columns``: the parsed fields wanted (all unless given; ``is_valid`` always
    comes). Only these are built: the generator that keeps each line's parse to
    one evaluation also keeps Catalyst from pruning fields, so ask for what is read.
    """
    base = with_batch_id(lines, batch_size)
    derived = derive_fields(extract_log_fields(base, raw))
    wanted = [c for c in DERIVED_COLUMNS if columns is None or c in columns or c == "is_valid"]
    return evaluate_once(derived.select(*base.columns, *wanted), wanted)


def filter_valid(flagged: DataFrame) -> DataFrame:
    """P2 (with the date/hour rule D4)."""
    return flagged.filter(F.col("is_valid"))


def count_malformed(flagged: DataFrame) -> DataFrame:
    """One row, ``malformed_count`` (0 when every line parses)."""
    return flagged.agg(F.count_if(~F.col("is_valid")).alias("malformed_count"))


def parse_access_log(lines: DataFrame, batch_size: int | None = None, raw: str = "raw",
                     columns: list[str] | None = None) -> DataFrame:
    """Raw lines (``ordinal``, ``raw`` and optionally ``file_index``) to parsed records
    (``columns``: the fields wanted, all unless given)."""
    flagged = flag_lines(lines, batch_size, raw, columns)
    return project_parsed(filter_valid(flagged))


def project_parsed(valid: DataFrame) -> DataFrame:
    """P12 for the parsed data set: the published column list, in order."""
    cols = [c for c in PARSED_COLUMNS if c in valid.columns]
    return valid.select(*cols)


def filter_has_path(parsed: DataFrame) -> DataFrame:
    """P10."""
    return parsed.filter(F.col("resource_path").isNotNull())


def filter_errors(parsed: DataFrame) -> DataFrame:
    """Status 400-599."""
    return parsed.filter(clf.is_error("status_code"))


def project_record(parsed: DataFrame) -> DataFrame:
    """The record fields only (no ordinal, no batch)."""
    return parsed.select(*RECORD_COLUMNS)
