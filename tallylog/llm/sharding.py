"""Sharding by histogram sort, in DataFrame operations only.

The rows are ordered by (key, row id). Candidate boundaries (probes) cut that
order into intervals; one aggregation counts the exact bytes and rows of each
interval. Intervals that are too heavy, or that hold a shard boundary and weigh
more than the tolerance, get new probes, until none is left. The shard
boundaries are then the probes nearest to the equal shares, and the rows are
exchanged once, by interval, to be numbered.

The row id is what splits a key that holds many rows: it is unique and is read
from a written table, so it does not change when tasks run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallylog.llm.common import constants, stage, table

LOWEST = -(1 << 63)
#: Rows of an interval, about: what one task sorts and numbers.
INTERVAL_ROWS = 1 << 18


def _interval(bounds: list[tuple[int, int]]) -> Column:
    """Index of the last boundary at or below (k, r), by binary search; -1 below all."""
    keys, rows = constants([k for k, _ in bounds], "bigint"), constants([r for _, r in bounds], "bigint")
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def step(at: Column, s: Column) -> Column:
        k, r = F.get(keys, at + s - 1), F.get(rows, at + s - 1)
        return F.when((k < F.col("k")) | ((k == F.col("k")) & (r <= F.col("r"))), at + s).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step) - 1


def _probes(lo: tuple[int, int], hi: tuple[int, int], last_row: int, n: int) -> list[tuple[int, int]]:
    """Up to ``n`` boundaries spread evenly between ``lo`` and ``hi``: over keys, or over the rows of one key."""
    last_key = hi[0] if hi[1] > 0 else hi[0] - 1
    if last_key > lo[0]:
        span = last_key - lo[0]
        keys = {lo[0] + max(1, -(-span * i // n)) for i in range(1, n + 1)}
        return [(k, 0) for k in sorted(keys) if lo < (k, 0) < hi]
    end = hi[1] if hi[0] == lo[0] else last_row + 1
    span = end - lo[1]
    rows = {lo[1] + span * i // (n + 1) for i in range(1, n + 1)}
    return [(lo[0], r) for r in sorted(rows) if lo < (lo[0], r) < hi]


def shard_by_bytes(df: DataFrame, key: str, size: Column, shards: int = 8, tolerance: float = 0.001,
                   interval_rows: int = INTERVAL_ROWS, least_intervals: int = 32, probes: int = 16) -> DataFrame:
    """Deal ``df`` into ``shards`` contiguous key ranges of near equal bytes.

    Returns the columns of ``df`` with ``shard`` (int, from 0) and ``slot`` (long,
    the place within the shard, gapless from 0); columns of these names in ``df``
    are replaced. ``key`` is an integer column; a null key sorts first. A null or
    negative ``size`` counts as 0. Equal keys, and wholly equal rows, are ordered
    by their place in the staged table and may be parted at a shard boundary.
    A shard misses its share by half of ``tolerance`` times a share, or by half of
    one row where single rows are heavier than that. An empty table gives no rows.
    The columns of ``df``, texts of any length among them, are staged and exchanged once each.

    The number of intervals follows from the number of rows: about one for each
    ``interval_rows`` of them, ``least_intervals`` a shard at least, so that a task has as
    much to sort and number at any size. The driver holds the boundary and the counts of
    each interval (40 bytes; 400,000 intervals for 10^11 rows), tasks the boundaries.
    """
    spark = df.sparkSession
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    rows = stage(df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        F.coalesce(F.col(f"`{key}`").cast("bigint"), F.lit(LOWEST)).alias("k"),
        F.monotonically_increasing_id().alias("r"),
        F.greatest(F.coalesce(size.cast("bigint"), F.lit(0)), F.lit(0)).alias("b")), "shard-rows")

    lowest, highest, last_row, total, count = rows.agg(
        F.min("k"), F.max("k"), F.max("r"), F.sum("b"), F.count(F.lit(1))).first()
    if not count:
        return rows.select("row.*", F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))

    intervals = max(shards * least_intervals, -(-count // interval_rows))
    heavy, many = total / intervals, 4 * count / intervals
    bounds, end = [(lowest, 0)], (highest, last_row + 1)
    new = _probes(bounds[0], end, last_row, intervals * 4)
    while True:
        bounds = sorted({*bounds, *new})
        weights = [(0, 0)] * len(bounds)
        for i, b, n in rows.groupBy(_interval(bounds).alias("i")).agg(F.sum("b"), F.count(F.lit(1))).collect():
            weights[i] = (b, n)
        new, below = [], 0
        for i, (b, n) in enumerate(weights):
            cut = any(below < total * s / shards < below + b for s in range(1, shards))
            if n > 1 and (b > heavy or n > many or cut and b > tolerance * total / shards):
                new += _probes(bounds[i], (bounds + [end])[i + 1], last_row, probes)
            below += b
        if not new:
            break

    sums = [0]
    for b, _ in weights:
        sums.append(sums[-1] + b)
    cuts = [min(range(len(sums)), key=lambda i, s=s: abs(sums[i] - total * s / shards)) for s in range(1, shards)]
    shard_of = [sum(c <= i for c in cuts) for i in range(len(bounds))]
    first_slot, filled = [], [0] * shards
    for s, (_, n) in zip(shard_of, weights):
        first_slot.append(filled[s])
        filled[s] += n

    place = F.row_number().over(Window.partitionBy("i").orderBy("k", "r")).cast("bigint") - 1
    return (rows.withColumn("i", _interval(bounds))
            .select("row", "i", place.alias("place"))
            .select("row.*", F.get(constants(shard_of, "int"), F.col("i")).alias("shard"),
                    (F.get(constants(first_slot, "bigint"), F.col("i")) + F.col("place")).alias("slot")))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder ``shard=<n>`` for each shard."""
    sharded.write.partitionBy("shard").parquet(path)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in 8 shards of near equal bytes (UTF-8 length plus 1; null text: 1)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    out = shard_by_bytes(rows, "doc_id", F.col("size"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
