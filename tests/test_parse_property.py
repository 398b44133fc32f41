"""Randomised parse check: Spark's flag_lines against a plain-Python reading of the rules."""

from __future__ import annotations

import datetime as dt
import re

from fixtures import lines_df
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from tallylog.functions.clf import LOG_PATTERN, MONTHS
from tallylog.operators import parse as P

# ASCII classes: \d is [0-9] and \s is [ \t\n\x0B\f\r], as in Java.
PATTERN = re.compile(LOG_PATTERN, re.ASCII)
DATE = re.compile(r"(\d\d)/(" + "|".join(MONTHS) + r")/(\d\d\d\d)", re.ASCII)
MAX_BIGINT = 2**63 - 1


def expected(line: str):
    m = PATTERN.match(line)
    if not m or m.group(4) == "-":
        return None
    host, ts, request, status, nbytes = m.groups()
    d = DATE.fullmatch(ts[:11])
    if not d:
        return None
    try:
        date = dt.date(int(d.group(3)), MONTHS.index(d.group(2)) + 1, int(d.group(1)))
    except ValueError:
        return None
    # the hour is the two characters read as an integer (spaces around, a sign allowed)
    hour_text = ts[12:14].strip(" ")
    if not re.fullmatch(r"[+-]?\d+", hour_text, re.ASCII) or not 0 <= int(hour_text) <= 23:
        return None
    tokens = re.findall(r"\S+", request, re.ASCII) + [None, None, None]
    size = 0 if nbytes == "-" else int(nbytes)
    return (host, date, int(hour_text), tokens[0], tokens[1], tokens[2], int(status),
            size if size <= MAX_BIGINT else 0)


ws = st.sampled_from([" ", "  ", "\t", " \t ", "\x0b"])
token = st.sampled_from(["GET", "HEAD", "/a", "/x|1", "/caf\xe9", "HTTP/1.0", "q=1", "\xa0"])
request = st.builds(
    lambda lead, toks, seps, tail: lead + "".join(t + s for t, s in zip(toks, seps)) + tail,
    st.sampled_from(["", " ", "\t"]),
    st.lists(token, max_size=5),
    st.lists(ws, min_size=5, max_size=5),
    st.sampled_from(["", " "]),
)
day = st.sampled_from(["01", "15", "31", "30", "29", "00", "1 ", "ab"])
month = st.sampled_from(["Jan", "Feb", "Jul", "Aug", "Dec", "jul", "Xxx"])
year = st.sampled_from(["1995", "2024", "2000", "1900", "0000", "95"])
hour = st.sampled_from(["00", "09", "23", "24", "99", "ab", "7", "-1", " 7", "7 ", "+7", "-0"])
stamp = st.builds(lambda d, m, y, h: f"{d}/{m}/{y}:{h}:00:00 -0400", day, month, year, hour)
status = st.sampled_from(["200", "304", "404", "500", "599", "-", "20", "2000", "abc"])
nbytes = st.sampled_from(["0", "123", "-", "9" * 19, "9" * 20, "12a", ""])
host = st.sampled_from(["h1", "199.72.81.55", "a.b", "", "x\xe9"])
sep = st.sampled_from([" ", " ", " ", "\t", "  "])


@st.composite
def log_line(draw):
    parts = [draw(host), draw(sep), "-", " ", "-", " ", "[", draw(stamp), "]", " ",
             '"', draw(request), '"', " ", draw(status), " ", draw(nbytes)]
    line = "".join(parts)
    mutate = draw(st.sampled_from(["none", "none", "none", "drop_bracket", "drop_quote", "trail", "lead"]))
    if mutate == "drop_bracket":
        line = line.replace("]", "", 1)
    elif mutate == "drop_quote":
        line = line.replace('"', "", 1)
    elif mutate == "trail":
        line += " "
    elif mutate == "lead":
        line = " " + line
    return line


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck),
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(st.lists(log_line(), min_size=50, max_size=120))
def test_flag_lines_matches_the_rules(spark, lines):
    rows = P.flag_lines(lines_df(spark, lines)).select(
        "ordinal", "is_valid", "host", "log_date", "log_hour", "http_method", "resource_path",
        "protocol_version", "status_code", "bytes_transferred").collect()
    got = {r["ordinal"]: (tuple(r)[2:] if r["is_valid"] else None) for r in rows}
    want = {i + 1: expected(line) for i, line in enumerate(lines)}
    bad = [(lines[k - 1], got[k], want[k]) for k in want if got[k] != want[k]]
    assert not bad, bad[:3]


def _half_even_6dp(e: int, t: int):
    """e/t to six decimals, ties to even, in exact integers (Python's own Decimal
    rounding of the exact fraction as the cross-check)."""
    from decimal import ROUND_HALF_EVEN, Decimal, localcontext
    with localcontext() as ctx:
        ctx.prec = 60
        return (Decimal(e) / Decimal(t)).quantize(Decimal("0.000001"), rounding=ROUND_HALF_EVEN)


pairs = st.one_of(
    st.tuples(st.integers(0, 10**9), st.integers(1, 10**9)).map(lambda p: (min(p), max(max(p), 1))),
    st.tuples(st.integers(0, 64), st.sampled_from([64, 128, 256, 640, 1280, 2**20])),  # ties
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck),
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(st.lists(pairs, min_size=100, max_size=300))
def test_rate_is_exact_half_even(spark, rows):
    from tallylog.functions.clf import rate_6dp
    df = spark.createDataFrame(rows, "e bigint, t bigint")
    got = [r[0] for r in df.select(rate_6dp("e", "t")).collect()]
    assert got == [_half_even_6dp(e, t) for e, t in rows]
