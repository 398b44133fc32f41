"""Column expressions for one Common Log Format line.

Everything here is a built-in Spark expression, so it stays inside whole-stage
codegen. Functions take and return ``Column`` objects; the DataFrame-level
operators in ``tallylog.operators`` compose them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The master pattern of the frozen parsing rules, and the order
# of its five capture groups.
LOG_PATTERN = r'^(\S+) \S+ \S+ \[([^\]]+)\] "([^"]*)" (\d{3}|-) (\d+|-)$'
GROUP_HOST = 1
GROUP_TIMESTAMP = 2
GROUP_REQUEST = 3
GROUP_STATUS = 4
GROUP_BYTES = 5

# Java's "$" also matches before a final line terminator (including U+0085,
# which a Latin-1 line can hold). The rules mean the end of the text, which is
# "\z" in Java; the pattern is otherwise the same.
SPARK_LOG_PATTERN = LOG_PATTERN[:-1] + r"\z"

# The date layout inside the brackets, the month names it takes
# (exact case), and the error range.
DATE_PATTERN = "dd/MMM/yyyy"  # first 11 characters of e.g. 01/Jul/1995:00:00:01 -0400
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
HOUR_START, HOUR_LENGTH = 13, 2
ERROR_STATUS_LOW, ERROR_STATUS_HIGH = 400, 599
NO_VALUE = "-"
RATE_SCALE = 1_000_000  # error rate kept to six decimal places


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_field(raw: Column | str, group: int) -> Column:
    """One capture group of the master pattern; '' when the line does not match."""
    return F.regexp_extract(_col(raw), SPARK_LOG_PATTERN, group)


# The five captures joined by a line feed, which no line read from text holds.
_JOINED_GROUPS = "\n".join(f"${g}" for g in range(1, 6))


def log_parts(raw: Column | str) -> Column:
    """All five captures in one pattern evaluation, as ARRAY<STRING>.

    A matching line is rewritten into its captures joined by "\\n" and split
    once, giving five elements. A line that does not match is left as it is,
    and since no line read from text holds "\\n" (it ends lines) it splits into
    one element. A line that does hold "\\n" takes the per-group path instead:
    five elements, or NULL without a match. So ``is_match(parts)`` is exact.
    """
    r = _col(raw)
    one_pass = F.split(F.regexp_replace(r, SPARK_LOG_PATTERN, _JOINED_GROUPS), "\n")
    per_group = F.when(
        log_field(r, GROUP_STATUS) != F.lit(""),
        F.array(*[log_field(r, g) for g in range(1, 6)]),
    )
    return F.when(F.instr(r, "\n") == F.lit(0), one_pass).otherwise(per_group)


def is_match(parts: Column | str) -> Column:
    return F.coalesce(F.size(_col(parts)) == F.lit(5), F.lit(False))


def log_date(timestamp_raw: Column | str) -> Column:
    """Calendar date in the line's own offset (no time-zone shift); NULL if unreadable.

    The month must be one of ``MONTHS`` as written (Spark's parser alone would
    also take "jul"), and the year 0001-9999 (Spark would also read year 0000,
    which no DATE column downstream can hold)."""
    ts = _col(timestamp_raw)
    return F.when(
        F.substring(ts, 4, 3).isin(MONTHS) & (F.substring(ts, 8, 4) != F.lit("0000")),
        F.try_to_date(F.substring(ts, 1, 11), DATE_PATTERN),
    )


def log_hour(timestamp_raw: Column | str) -> Column:
    """Hour of day in the line's own offset; NULL if not a number."""
    return F.substring(_col(timestamp_raw), HOUR_START, HOUR_LENGTH).try_cast("int")


def request_tokens(request_raw: Column | str) -> Column:
    """The request split on runs of whitespace, with empty tokens dropped.

    Written as the maximal runs of non-whitespace, which is the same list and
    needs neither a lambda nor a second pass.
    """
    return F.regexp_extract_all(_col(request_raw), F.lit(r"\S+"), 0)


def request_token(tokens: Column, position: int) -> Column:
    """Token at 1-based ``position``; NULL when the request is shorter."""
    return F.try_element_at(tokens, F.lit(position))


def bytes_transferred(bytes_raw: Column | str) -> Column:
    """'-' becomes 0; digits become BIGINT; a value too large for BIGINT becomes 0."""
    b = _col(bytes_raw)
    return (
        F.when(b == F.lit(NO_VALUE), F.lit(0).cast("bigint"))
        .otherwise(F.coalesce(b.try_cast("bigint"), F.lit(0).cast("bigint")))
    )


def status_code(status_raw: Column | str) -> Column:
    return _col(status_raw).try_cast("int")


def is_valid_line(status_raw: Column | str, date: Column | str, hour: Column | str) -> Column:
    """A line is kept iff the pattern matched, the status is not '-', and its
    date and hour are readable (hour 0-23). Never NULL."""
    s, d, h = _col(status_raw), _col(date), _col(hour)
    return F.coalesce(
        (s != F.lit(""))
        & (s != F.lit(NO_VALUE))
        & d.isNotNull()
        & h.between(0, 23),
        F.lit(False),
    )


def is_error(status: Column | str) -> Column:
    return _col(status).between(ERROR_STATUS_LOW, ERROR_STATUS_HIGH)


def int_div(a: Column | str, b: Column | str) -> Column:
    """Exact integer division (SQL ``a div b``), BIGINT."""
    return F.call_function("div", _col(a), _col(b))


def batch_by_lines(ordinal: Column | str, batch_size: int) -> Column:
    """batch_id = floor((ordinal - 1) / N) + 1, for N > 0."""
    if batch_size is None or int(batch_size) <= 0:
        raise ValueError("batch size must be a positive integer")
    return (int_div(_col(ordinal) - F.lit(1), F.lit(int(batch_size))) + 1).cast("bigint")


def rate_6dp(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator rounded half-to-even at six decimals, exactly.

    Integer arithmetic only: q = n*10^6 div d, r = n*10^6 mod d, and q goes up
    by one when 2r > d, or 2r = d and q is odd. Result DECIMAL(20,6); NULL when
    the denominator is 0.
    """
    n = _col(numerator).cast("bigint") * F.lit(RATE_SCALE)
    d = _col(denominator).cast("bigint")
    q = int_div(n, d)
    r = n - q * d
    up = (F.lit(2) * r > d) | ((F.lit(2) * r == d) & (q % 2 == 1))
    scaled = q + F.when(up, F.lit(1)).otherwise(F.lit(0))
    value = scaled.cast("decimal(20,0)") / F.lit(RATE_SCALE).cast("decimal(7,0)")
    return F.when(d > 0, value.cast("decimal(20,6)"))


#: The largest BIGINT: what a sum of bytes that does not fit is reported as.
MAX_BYTES = (1 << 63) - 1


def sum_bytes(value: Column | str) -> Column:
    """Sum of non-negative BIGINTs; 0 without rows, MAX_BYTES where the sum does not fit."""
    v = _col(value)
    return F.coalesce(F.try_sum(v), F.when(F.count(v) > 0, F.lit(MAX_BYTES)), F.lit(0)).cast("bigint")
