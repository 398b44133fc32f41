"""Document fingerprints by winnowing, in DataFrame operations only.

All k-grams of code points of a text are hashed, each anew; of each window of w
neighbouring hashes the smallest is chosen, the rightmost on ties. The chosen
hashes, with their positions, are the fingerprint: any match of k + w - 1 code
points shares one of them.

The text is taken as 4 bytes a code point, so a k-gram is a slice at a known
place and a long text costs as much a code point as a short one. Window minima
come by doubling: minima over 2, 4, 8, ... hashes, each from two of the array
before. Hash and place sit in one long, the hash above the place counted
backwards, so the smallest long is the smallest hash at its rightmost place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallylog.llm.common import constants, let, stage, table

K = 16
WINDOW = 16
#: Neighbouring texts that meet in one window.
BLOCK = 1024
#: Longest text in code points: 2^31 - 1, as places are counted backwards from here.
LAST = (1 << 31) - 1


def _shifted_min(values: Column, by: int) -> Column:
    """The smaller of each value and the one ``by`` places on; as many as there are pairs."""
    n = F.size(values) - by
    return F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(by + 1), n), lambda a, b: F.least(a, b))


def minima(df: DataFrame, text: str, out: str, k: int = K, window: int = WINDOW) -> DataFrame:
    """Add ``out``: the choice of each window in order, packed (array of longs).

    A text shorter than ``k`` is one gram; one with fewer grams than a window is one
    window; an empty or null text has no grams and an empty array.
    """
    b, g, m = f"__{out}_b", f"__{out}_g", f"__{out}_m"
    df = df.withColumn(b, F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-32"))
    grams = F.greatest(F.floor(F.length(b) / 4) - (k - 1), F.least(F.length(b), F.lit(1))).cast("int")

    def hashed(data: Column) -> Column:
        def gram(i: Column) -> Column:
            h = F.xxhash64(F.substring(data, i * 4 + 1, F.lit(4 * k)))
            return F.shiftleft(h.bitwiseAND(F.lit(0xFFFFFFFF)), 31).bitwiseOR(F.lit(LAST) - i)

        return F.transform(F.sequence(F.lit(0), grams - 1), gram)

    # the bytes are bound once: read from the row, they would be copied for each gram
    df = df.withColumn(g, F.when(grams > 0, let(F.col(b), hashed)).otherwise(F.array().cast("array<bigint>")))
    # minima over `done` hashes; then over `window`, by an overlap
    done, df = 1, df.withColumn(m, F.col(g))
    while done < window:
        by = min(done, window - done)
        df = df.withColumn(m, F.when(F.size(g) >= window, _shifted_min(F.col(m), by)))
        done += by
    short = F.when(F.size(g) > 0, F.array(F.array_min(g))).otherwise(F.col(g))
    return df.withColumn(out, F.coalesce(F.col(m), short)).drop(b, g, m)


def unpacked(choices: Column) -> Column:
    """Packed choices as struct(hash long, place int); hashes have 32 bits, places count code points from 0."""
    return F.transform(choices, lambda v: F.struct(
        F.shiftright(v, 31).alias("hash"), (F.lit(LAST) - v.bitwiseAND(F.lit(LAST))).cast("int").alias("place")))


def winnow(df: DataFrame, text: str, out: str, k: int = K, window: int = WINDOW) -> DataFrame:
    """Add ``out``: the fingerprint of ``text``, an array of struct(hash, place) in order of place."""
    m = f"__{out}_windows"
    return minima(df, text, m, k, window).withColumn(out, unpacked(F.array_distinct(m))).drop(m)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of the hash sets of two packed fingerprints, 0 to 1; 1 for two empty ones."""
    x, y = (F.transform(c, lambda v: F.shiftright(v, 31)) for c in (a, b))
    both, either = F.size(F.array_intersect(x, y)), F.size(F.array_union(x, y))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def digest(fingerprint: Column) -> Column:
    """A fingerprint as 64 hex digits; equal fingerprints have equal digests."""
    return F.sha2(F.to_json(F.struct(fingerprint["hash"].alias("h"), fingerprint["place"].alias("p"))), 256)


def _places(groups: DataFrame) -> tuple[DataFrame, int]:
    """Add ``n``, the place from 0 in ascending doc_id, then mark, to the distinct ``groups``; and their number.

    The groups are range-partitioned and written; a window over each partition and
    the counts of the partitions before it give the places.
    """
    parts = stage(groups.repartitionByRange("doc_id", "mark").withColumn("part", F.spark_partition_id()), "winnow-order")
    counts = sorted((p, n) for p, n in parts.groupBy("part").count().collect())  # one row a partition
    before, total = [0] * (1 + max((p for p, _ in counts), default=-1)), 0
    for p, n in counts:
        before[p], total = total, total + n
    place = F.row_number().over(Window.partitionBy("part").orderBy("doc_id", "mark")).cast("bigint") - 1
    return parts.select("doc_id", "mark", "copies", (place + F.get(constants(before, "bigint"), F.col("part"))).alias("n")), total


def fingerprints_with_edits(docs: DataFrame, k: int = K, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Fingerprint each text of ``docs`` (doc_id, text), its edit, and compare with the next text's.

    The edit replaces the last quarter (floor of n_chars / 4 code points) by the
    first as many of the next text, or all if it has fewer; the last row's next is
    the first, a single row's next is itself. A null text counts as empty; a null
    doc_id comes first; rows of one doc_id are ordered by text hash, so the next of a
    repeated row is its own copy, but for the last. An empty table gives no rows.

    Returns doc_id, n_chars, edited (text), fingerprint, edited_fingerprint (arrays
    of hash and place), near_edited, near_next.

    Repeated rows are one group with a count. Blocks of ``block`` neighbouring
    groups meet in one window; the first of each block goes to the block before as
    well. Texts are moved to find their place and to meet their neighbours, and at
    no other time. A long text is hashed whole: a task holds some arrays with a long for
    each of its code points. Other columns, of any name, are not read.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("mark", F.xxhash64("text"))
    groups, total = _places(texts.groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("copies")))
    groups = stage(groups.select(F.col("doc_id").alias("id"), F.col("mark").alias("m"), "copies", "n"), "winnow-places")
    found = texts["doc_id"].eqNullSafe(groups["id"]) & (texts["mark"] == groups["m"])
    placed = texts.join(groups.filter("copies = 1"), found).select("n", "copies", "doc_id", "text")
    repeated = groups.filter("copies > 1")
    if not repeated.isEmpty():
        placed = placed.unionByName(
            texts.join(repeated, found).groupBy("n", "copies", "doc_id").agg(F.first("text").alias("text")))

    # the first of a block also ends the block before; the very first ends the last one
    last = F.lit(total - 1) if total else F.lit(0)
    own = F.struct(F.floor(F.col("n") / block).alias("block"), F.col("n").alias("at"))
    ahead = F.when(F.col("n") > 0, F.struct(F.floor(F.col("n") / block - 1).alias("block"), F.col("n").alias("at"))).otherwise(
        F.struct(F.floor(last / block).alias("block"), (last + 1).alias("at")))
    spread = (placed.withColumn("to", F.explode(F.when(F.col("n") % block == 0, F.array(own, ahead)).otherwise(F.array(own))))
              .select("to.block", "to.at", "n", "copies", "doc_id", "text").repartition("block"))
    # `same`: so many choices are made by windows that lie before the edit, which the edited text shares
    untouched = F.greatest(F.expr("n_chars - n_chars div 4") - (k + window - 2), F.lit(0)).cast("int")
    prints = (minima(spread, "text", "windows", k, window).withColumn("n_chars", F.length("text"))
              .withColumn("untouched", untouched).withColumn("own", F.array_distinct("windows"))
              .withColumn("same", F.when(F.col("untouched") > 0, F.array_position("own", F.try_element_at("windows", "untouched"))).otherwise(0).cast("int"))
              .drop("windows"))
    w = Window.partitionBy("block").orderBy("at")
    once, more = F.lit(1).cast("bigint"), F.col("copies") - 1
    met = (prints.withColumn("need", F.lag(F.floor(F.col("n_chars") / 4).cast("int")).over(w))
           .withColumn("head", F.expr("substring(text, 1, need)"))
           .withColumn("next", F.lead(F.struct("head", F.col("own").alias("print"))).over(w))
           .filter((F.col("block") == F.floor(F.col("n") / block)) & (F.col("at") == F.col("n")))
           # a repeated row is followed by its own copy, but for the last
           .withColumn("self", F.struct(F.expr("substring(text, 1, n_chars div 4)").alias("head"), F.col("own").alias("print")))
           .withColumn("case", F.explode(F.when(F.col("copies") > 1, F.array(
               F.struct(once.alias("times"), F.col("next")), F.struct(more.alias("times"), F.col("self").alias("next"))))
               .otherwise(F.array(F.struct(once.alias("times"), F.col("next"))))))
           .select("doc_id", "text", "n_chars", "untouched", "own", "same", "case.times", "case.next")
           .withColumn("edited", F.concat(F.expr("substring(text, 1, n_chars - n_chars div 4)"), "next.head"))
           .withColumn("tail", F.expr("substring(edited, untouched + 1)")))
    # the windows that reach into the edit; none where nothing came in its place and some windows stay
    late = F.when((F.col("untouched") > 0) & (F.length("next.head") == 0), F.array().cast("array<bigint>")).otherwise(
        F.transform(F.array_distinct("late"), lambda v: v - F.col("untouched")))
    out = (minima(met, "tail", "late", k, window)
           .withColumn("new", F.array_distinct(F.concat(F.slice("own", F.lit(1), F.col("same")), late)))
           .select("times", "doc_id", F.col("n_chars").cast("bigint").alias("n_chars"), "edited",
                   unpacked(F.col("own")).alias("fingerprint"), unpacked(F.col("new")).alias("edited_fingerprint"),
                   likeness(F.col("own"), F.col("new")).alias("near_edited"),
                   likeness(F.col("own"), F.col("next.print")).alias("near_next")))
    return out.withColumn("time", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times")))).drop("time", "times")


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and of their edits."""
    out = fingerprints_with_edits(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                      digest(F.col("fingerprint")).alias("fingerprint"),
                      digest(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")
