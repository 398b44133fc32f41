"""Hand-written log lines, with totals worked out by hand in the tests, and small helpers."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def clf(host: str, day: str, clock: str, request: str, status: str, nbytes: str,
        month: str = "Jul", year: str = "1995") -> str:
    return f'{host} - - [{day}/{month}/{year}:{clock} -0400] "{request}" {status} {nbytes}'


def get(path: str) -> str:
    return f"GET {path} HTTP/1.0"


# Fourteen lines over three days: 12 valid (one of them without a path), 2 malformed.
SHOP_LOG = [
    'alpha.example - - [03/Mar/1999:05:10:00 +0100] "GET /home HTTP/1.1" 200 1200',
    'beta.example - - [03/Mar/1999:05:15:30 +0100] "GET /home HTTP/1.1" 304 -',
    'alpha.example - - [03/Mar/1999:05:59:59 +0100] "GET /cart HTTP/1.1" 503 80',
    'gamma.example - - [03/Mar/1999:06:00:00 +0100] "POST /cart HTTP/1.1" 200 40',
    'gamma.example - - [03/Mar/1999:06:30:00 +0100] "GET /home HTTP/1.1" 200 1200',
    'delta.example - - [03/Mar/1999:06:31:00 +0100] "GET /help HTTP/1.1" 404 310',
    'broken',
    'delta.example - - [04/Mar/1999:23:00:01 +0100] "GET /home HTTP/1.1" 200 1300',
    'alpha.example - - [04/Mar/1999:23:05:00 +0100] "GET /cart HTTP/1.1" 500 90',
    'beta.example - - [04/Mar/1999:23:06:00 +0100] "GET /cart HTTP/1.1" 404 10',
    'beta.example - - [04/Mar/1999:23:07:00 +0100] "GET /cart HTTP/1.1" 404 10',
    'gamma.example - - [04/Mar/1999:23:08:00 +0100] "GET /home HTTP/1.1" - 55',
    'alpha.example - - [04/Mar/1999:23:59:00 +0100] "GET" 200 7',
    'epsilon.example - - [05/Mar/1999:00:00:00 +0100] "GET /help HTTP/1.1" 200 310',
]

# Nine lines: 4 valid (one with bytes "-"), 5 malformed.
PARSE_LOG = [
    'mail.example.net ident alice [28/Feb/2000:23:59:58 +0000] "GET /inbox?page=2 HTTP/1.1" 200 5120',
    '10.0.0.7 - - [29/Feb/2000:00:00:00 +0000] "HEAD /inbox HTTP/1.1" 204 -',
    '10.0.0.8 - - [29/Feb/2000:12:30:00 +0000] "PUT /draft/4 HTTP/2" 201 17',
    '10.0.0.9 - - [29/Feb/2000:12:31:00 +0000] "-" 400 0',
    '10.0.0.9 - - [30/Feb/2000:12:31:00 +0000] "GET /no-such-day HTTP/1.1" 200 1',
    '10.0.0.9 - - [29/Feb/2000:24:31:00 +0000] "GET /no-such-hour HTTP/1.1" 200 1',
    '10.0.0.9 - - [29/Feb/2000:12:31:00 +0000] "GET /no-status HTTP/1.1" - 1',
    '# comment',
    '',
]

LINES_SCHEMA = T.StructType([
    T.StructField("ordinal", T.LongType(), False),
    T.StructField("raw", T.StringType(), True),
])


def lines_df(spark: SparkSession, lines: list[str]) -> DataFrame:
    """(ordinal, raw) with ordinals 1..n in list order."""
    return spark.createDataFrame([(i + 1, s) for i, s in enumerate(lines)], LINES_SCHEMA)


def write_file(folder: str, name: str, lines: list[str] | bytes, newline: str = "\n") -> str:
    path = os.path.join(folder, name)
    data = lines if isinstance(lines, bytes) else (newline.join(lines) + newline).encode("latin-1")
    if name.endswith(".gz"):
        import gzip
        with gzip.open(path, "wb") as fh:
            fh.write(data)
    else:
        with open(path, "wb") as fh:
            fh.write(data)
    return path
