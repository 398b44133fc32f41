"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def diff_runs(first: DataFrame, second: DataFrame) -> DataFrame:
    """Bag difference both ways, tagged with ``side``; empty when the two agree.

    Rows of the first count +1 and those of the second -1; one aggregation by all columns
    (nulls are equal) leaves the surplus of each row, which is returned as often as that: a
    row present twice in one result and once in the other is reported once.
    """
    cols = first.columns
    quoted = [f"`{c}`" for c in cols]
    rows = [df.select(F.struct(*quoted).alias("row"), F.lit(sign).alias("sign")) for df, sign in ((first, 1), (second, -1))]
    surplus = rows[0].unionByName(rows[1]).groupBy("row").agg(F.sum("sign").alias("n")).filter(F.col("n") != 0)
    side = F.when(F.col("n") > 0, F.lit("only_in_first")).otherwise(F.lit("only_in_second"))
    return surplus.select(side.alias("side"), "row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("n")))).select("side", "row.*")
