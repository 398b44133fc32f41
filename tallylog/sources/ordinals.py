"""Line ordinals and batches taken from files.

Every line is numbered 1..N over all inputs in input order with no global sort, and
without moving or rewriting the lines for it:

1. each line carries ``row_id`` from the scan, consecutive inside one split. Either the
   scan is pinned (``read_log_lines``), so that a second scan gives the same ids, or the
   lines come from a written table (the job: its staged records);
2. one aggregate gives, per split and per block of ROWS_IN_BLOCK row ids in it, the first
   row_id and the line counts: one small row per block. A file that no codec can split is
   one split of any length, but many such blocks;
3. the file table (one row per input file) meets those rows, not the lines, and running
   sums give the lines before each block: within a file, and across files by blocks of
   files, so no window takes all files at once. The result, the split table, is written;
4. ordinal = lines_before + (row_id - first_row_id) + 1, by an equi-join of the lines
   with the split table, whose plan Spark picks from the measured size. No key of that
   join holds more than ROWS_IN_BLOCK lines. A line that the split table does not hold
   (the input has changed since) is an error, never a wrong number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallylog.functions import clf
from tallylog.session import staging_path

SPLIT_COLUMNS = ["file_path", "block_start", "row_id"]
# Row ids in a block, a power of two: the most lines that one join key holds.
ROWS_IN_BLOCK = 1 << 20
# Input files whose totals are summed in one window.
FILES_IN_BLOCK = 1024

BLOCK_KEYS = ["file_path", "block_start", "row_block"]


def _with_row_block(lines: DataFrame) -> DataFrame:
    return lines.withColumn("row_block", F.shiftright("row_id", ROWS_IN_BLOCK.bit_length() - 1))


def split_offsets(lines: DataFrame, file_table: DataFrame | None = None) -> DataFrame:
    """Per block of a split: its file, first row_id, line counts, and the number of lines before it.

    Without a ``file_table`` the lines carry file_index and file_order themselves
    (``tag_source_file``). When they carry ``is_valid`` (parsed lines), each block also
    records its valid-line count and the largest row_id of a valid line, from which the
    run statistics follow without another pass over the lines.
    """
    aggs = [F.min("row_id").alias("first_row_id"), F.count(F.lit(1)).alias("n_lines")]
    flagged = "is_valid" in lines.columns
    if flagged:
        aggs += [F.count_if(F.col("is_valid")).alias("n_valid"),
                 F.max(F.when(F.col("is_valid"), F.col("row_id"))).alias("last_valid_row_id")]
    if file_table is None:
        aggs += [F.first("file_index").alias("file_index"), F.first("file_order").alias("file_order")]
    splits = _with_row_block(lines).groupBy(*BLOCK_KEYS).agg(*aggs)
    if file_table is not None:
        splits = splits.join(file_table, "file_path")

    def before(partition: str, order: list[str], value: str) -> Column:
        w = Window.partitionBy(partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(value).over(w), F.lit(0))

    splits = splits.withColumn("before_in_file", before("file_path", ["block_start", "row_block"], "n_lines"))
    files = (splits.groupBy("file_order").agg(F.sum("n_lines").alias("file_lines"))
             .withColumn("block", clf.int_div("file_order", F.lit(FILES_IN_BLOCK)))
             .withColumn("before_in_block", before("block", ["file_order"], "file_lines")))
    blocks = (files.groupBy("block").agg(F.sum("file_lines").alias("block_lines")).withColumn("all", F.lit(0))
              .withColumn("before_block", before("all", ["block"], "block_lines")).select("block", "before_block"))
    starts = files.join(blocks, "block").select("file_order", (F.col("before_block") + F.col("before_in_block")).alias("before_file"))
    extra = ["n_valid", "last_valid_row_id"] if flagged else []
    return splits.join(starts, "file_order").select(
        *BLOCK_KEYS, "file_order", "file_index", "first_row_id", "n_lines", *extra,
        (F.col("before_file") + F.col("before_in_file")).cast("bigint").alias("lines_before"),
    )


def write_split_table(lines: DataFrame, file_table: DataFrame | None = None, path: str | None = None) -> DataFrame:
    """The split table written as parquet (under the shared folder unless a path is
    given), where the lineage is cut, and read back."""
    spark = lines.sparkSession
    path = path or staging_path(spark, "split-offsets")
    split_offsets(lines, file_table).write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def _stats(offsets: DataFrame, batches: Column) -> DataFrame:
    counts = offsets.agg(
        F.coalesce(F.sum("n_valid"), F.lit(0)).cast("bigint").alias("total_records"),
        F.coalesce(F.max(batches), F.lit(0)).cast("bigint").alias("num_batches"),
        F.coalesce(F.sum(F.col("n_lines") - F.col("n_valid")), F.lit(0)).cast("bigint").alias("malformed_count"),
    )
    total, n = F.col("total_records"), F.col("num_batches")
    return counts.select(
        "total_records", "num_batches",
        F.coalesce(F.try_divide(total.cast("double"), n.cast("double")), F.lit(0.0)).alias("avg_batch_size"),
        "malformed_count",
    )


def line_batch_stats(offsets: DataFrame, batch_size: int) -> DataFrame:
    """B7 for line batches, from the split table alone (one row per split):
    parsed records, malformed lines, and num_batches = the batch of the largest
    ordinal held by a parsed record. Same row as ``run_stats`` over the lines."""
    last_valid = F.col("lines_before") + F.col("last_valid_row_id") - F.col("first_row_id") + F.lit(1)
    return _stats(offsets, clf.batch_by_lines(last_valid, batch_size))


def file_batch_stats(offsets: DataFrame) -> DataFrame:
    """B7 for file batches, from the split table alone: the last file with a parsed record counts."""
    return _stats(offsets, F.when(F.col("n_valid") > 0, F.col("file_index")))


def number_with(lines: DataFrame, offsets: DataFrame) -> DataFrame:
    """ordinal = lines before the block + place in the block + 1, and file_index, by a
    join to the written split table. A line without a place in that table is an error."""
    side = offsets.select(*BLOCK_KEYS, "file_index", "first_row_id", "n_lines", "lines_before")
    place = F.col("row_id") - F.col("first_row_id")
    ordinal = F.when(F.coalesce(place.between(0, F.col("n_lines") - 1), F.lit(False)), F.col("lines_before") + place + F.lit(1)).otherwise(
        F.raise_error(F.concat(F.lit("the input has changed while its lines were numbered: "), F.col("file_path"))).cast("bigint"))
    return _with_row_block(lines.drop("file_index")).join(side, BLOCK_KEYS, "left").withColumn("ordinal", ordinal).drop(
        "row_block", "first_row_id", "n_lines", "lines_before")


def number_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """B1: the numbered lines and the written split table.

    ``lines`` comes from ``read_log_lines`` or from a written table of its columns. They
    are read twice, once for the split table and once to be numbered, and never written here.
    """
    offsets = write_split_table(lines)
    return number_with(lines, offsets), offsets


def assign_ordinal(lines: DataFrame) -> DataFrame:
    """B1: add ``ordinal`` (1-based over all lines of all inputs, malformed ones included)."""
    return number_lines(lines)[0]


def batch_by_file(lines: DataFrame) -> DataFrame:
    """Without a batch size, each input file is one batch."""
    return lines.withColumn("batch_id", F.col("file_index").cast("bigint"))


# A batch number in a file name such as batch_007.log, or in a
# folder written by ``write_line_batches`` such as batch_id=7.
BATCH_NAME_PATTERN = r"(?:^|/)batch_(\d+)\.log$"
BATCH_FOLDER_PATTERN = r"/batch_id=(\d+)/"


def batch_from_file_name(file_path: Column | str = "file_path", file_index: Column | str = "file_index") -> Column:
    """Batch number read from the file name; else the file's index; else 1."""
    path = F.col(file_path) if isinstance(file_path, str) else file_path
    index = F.col(file_index) if isinstance(file_index, str) else file_index

    def grab(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")).try_cast("bigint")

    return F.coalesce(grab(BATCH_NAME_PATTERN), grab(BATCH_FOLDER_PATTERN), index.cast("bigint"), F.lit(1).cast("bigint"))


# Lines that one task writes of a batch.
CHUNK_LINES = 1_000_000


def write_line_batches(lines: DataFrame, batch_size: int, root: str, chunk_lines: int = CHUNK_LINES,
                       offsets: DataFrame | None = None) -> str:
    """Write the raw lines as numbered batches of exactly N lines; they are written once, here.

    Layout ``root/batch_id=K/chunk=C/part-*.txt``: a batch is one folder, cut into
    chunks of at most ``chunk_lines`` lines, each written in ordinal order. Reading the
    batches back in natural name order (batch, then chunk) gives the original line
    order. A batch may take lines from two input files. The number of tasks comes
    from the number of lines: about ``chunk_lines`` each, however the session is set.
    ``offsets``: the split table of ``number_lines``, which saves a pass to count the lines.
    """
    last = (lines.agg(F.max("ordinal")) if offsets is None else offsets.agg(F.sum("n_lines"))).first()[0] or 0
    tasks = max(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-last // chunk_lines))
    placed = lines.withColumns({
        "batch_id": clf.batch_by_lines("ordinal", batch_size),
        "chunk": clf.int_div(F.pmod(F.col("ordinal") - F.lit(1), F.lit(int(batch_size))), F.lit(int(chunk_lines))),
    })
    (placed.repartition(tasks, "batch_id", "chunk")
     .sortWithinPartitions("batch_id", "chunk", "ordinal")
     .select("batch_id", "chunk", "raw")
     .write.mode("errorifexists").partitionBy("batch_id", "chunk").text(root))
    return root
