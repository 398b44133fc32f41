"""Raw log lines from text files.

An *input* is either one file or a directory. In a directory, every entry whose
name starts with the prefix (``NASA_access_log_`` by default) is one input file;
an entry may itself be a folder written by Spark (its part files, in name order,
make up that one input). Inputs are ordered by rule D1: names carrying a
month-year stamp such as ``Jul95`` in calendar order first, then the rest by
name. Callers may pass an explicit list instead.

The listing runs as a Spark job over the ``binaryFile`` source with only
``path`` and ``length`` selected, so no file content is read; the prefix is part of
the listed path, so only the chosen files (one row each) come back to the driver,
which it needs to plan the scan anyway. Names may hold any character: they are
escaped before they are read as paths. A file named twice is read once.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylog.functions.clf import MONTHS

DEFAULT_PREFIX = "NASA_access_log_"
_STAMP = re.compile(r"(" + "|".join(MONTHS) + r")(\d{2}|\d{4})(?!\d)")

# Codecs whose files Hadoop cannot split (one task reads the file).
UNSPLITTABLE_SUFFIXES = (".gz", ".deflate", ".zst", ".lz4", ".snappy")


@dataclass(frozen=True)
class InputFile:
    path: str          # as the file system lists it (scheme included); used to open it
    entry: str         # name of the directory entry it belongs to
    entry_index: int   # 1-based position of the entry (the file batch)
    file_order: int    # 1-based position of this file over all inputs
    length: int
    scan_path: str = ""  # the same file as a scan's ``_metadata.file_path`` names it (URI-encoded)


def _strip_scheme(p: str) -> str:
    p = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "", p)
    return re.sub(r"^file:", "", p)


def natural_key(name: str) -> tuple:
    """Digit runs compare as numbers: batch_id=2 before batch_id=10."""
    return tuple((0, int(part), "") if part.isdigit() else (1, 0, part)
                 for part in re.split(r"(\d+)", name) if part != "")


def entry_sort_key(name: str) -> tuple:
    """Month-stamped names in calendar order, then all other names in natural order."""
    m = _STAMP.search(name)
    if m:
        year = int(m.group(2))
        if year < 100:
            year += 1900 if year >= 70 else 2000
        return (0, year, MONTHS.index(m.group(1)) + 1, natural_key(name))
    return (1, 0, 0, natural_key(name))


def escape_glob(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _listing(spark: SparkSession, path: str, only: str | None = None) -> list | None:
    """(path, length, scan_path) of the files under a path; None where there is no such path.

    ``only``: just the file of this name (without scheme).
    """
    reader = spark.read.format("binaryFile")
    if only is None:
        reader = reader.option("recursiveFileLookup", "true")
    try:
        found = reader.load(path).select("path", "length", F.col("_metadata.file_path").alias("scan_path"))
        if only is not None:
            found = found.filter(F.regexp_replace("path", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "") == F.lit(only))
        return found.collect()
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def list_inputs(spark: SparkSession, inputs: str | list[str], name_prefix: str = DEFAULT_PREFIX) -> list[InputFile]:
    """Resolve a directory, a single file, or an explicit ordered list of them."""
    if isinstance(inputs, (list, tuple)):
        files: dict[str, InputFile] = {}
        for item in inputs:
            for f in list_inputs(spark, item, name_prefix):
                files.setdefault(f.path, f)
        return _renumber(list(files.values()))

    base = str(inputs).rstrip("/") or "/"
    if not re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", base) and not base.startswith("/"):
        base = os.path.abspath(base)  # a relative local path, as the listing reports it absolute
    base_plain = _strip_scheme(base)
    listing = _listing(spark, f"{escape_glob(base)}/{escape_glob(name_prefix)}*") or []
    if not listing:  # the input is a single file, taken whatever its name, or has no such entry
        listing = _listing(spark, escape_glob(base), only=base_plain)
        if listing is None:
            raise FileNotFoundError(f"input does not exist: {base}")
    grouped: dict[str, list[tuple[str, str, int, str]]] = {}
    for row in listing:
        plain = _strip_scheme(row["path"])
        rel = plain[len(base_plain):].lstrip("/") if plain.startswith(base_plain) else ""
        if rel == "":
            # the input is a single file: taken whatever its name
            grouped.setdefault(plain.rsplit("/", 1)[-1], []).append(
                (row["path"], "", row["length"], row["scan_path"]))
            continue
        entry = rel.split("/", 1)[0]
        if entry.startswith(name_prefix):
            grouped.setdefault(entry, []).append((row["path"], rel, row["length"], row["scan_path"]))
    if not grouped:
        raise FileNotFoundError(f"no {name_prefix}* entries in {base}")
    files = []
    for entry in sorted(grouped, key=entry_sort_key):
        for path, _, length, scan_path in sorted(grouped[entry], key=lambda t: natural_key(t[1])):
            files.append(InputFile(path, entry, 0, 0, length, scan_path))
    return _renumber(files)


def _entry_path(f: InputFile) -> str:
    """Full path of the entry a file belongs to (the file itself for a plain file)."""
    marker = "/" + f.entry + "/"
    i = f.path.rfind(marker)
    return f.path[: i + len(marker) - 1] if i >= 0 else f.path


def _renumber(files: list[InputFile]) -> list[InputFile]:
    out, entry_ix, last = [], 0, None
    for i, f in enumerate(files, start=1):
        key = _entry_path(f)
        if key != last:
            entry_ix += 1
            last = key
        out.append(InputFile(f.path, f.entry, entry_ix, i, f.length, f.scan_path))
    return out


def files_frame(spark: SparkSession, files: list[InputFile]) -> DataFrame:
    """The file table: (file_path, file_entry, file_index, file_order), one row per
    file. ``file_path`` is the scan's own (URI-encoded) form, so it joins exactly."""
    schema = T.StructType([
        T.StructField("file_path", T.StringType(), False),
        T.StructField("file_entry", T.StringType(), False),
        T.StructField("file_index", T.IntegerType(), False),
        T.StructField("file_order", T.IntegerType(), False),
    ])
    return spark.createDataFrame(
        [(f.scan_path or f.path, f.entry, f.entry_index, f.file_order) for f in files], schema)


def decode_latin1(value: F.Column) -> F.Column:
    """S3: the line's bytes read as ISO-8859-1, so no byte is lost or replaced."""
    return F.decode(value.cast("binary"), "ISO-8859-1")


def scan_lines(spark: SparkSession, files: list[InputFile]) -> DataFrame:
    """Every line of every file, untokenised, with its file and split position.

    Columns: raw, file_path, block_start, row_id. ``.gz`` files are
    decompressed by the text source (one split per file). Lines end at \\n,
    \\r\\n or \\r. ``row_id`` is ``monotonically_increasing_id()`` taken right at
    the scan: consecutive within one split, and the same on every re-read of
    the same files under the same split settings (a retried task reads the same
    split again), which is what ``assign_ordinal`` builds on.
    """
    scan = spark.read.text([escape_glob(f.path) for f in files])
    return scan.select(
        decode_latin1(F.col("value")).alias("raw"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
    )


def scan_spread(spark: SparkSession, files: list[InputFile]) -> DataFrame:
    """S1-S3 with skew handling for files that cannot be split (by their codec).

    Such a file is read by one task whatever its size; its lines are then dealt
    out round-robin right after the scan, so decompression stays one stream but
    parsing runs everywhere. Only those files' lines move: the other files are
    scanned on their own and stay where they are read. Row ids are taken at each
    scan; numbering needs them consecutive within a split only, and split keys
    never repeat across the two scans.
    """
    whole = [f for f in files if f.path.lower().endswith(UNSPLITTABLE_SUFFIXES)]
    rest = [f for f in files if not f.path.lower().endswith(UNSPLITTABLE_SUFFIXES)]
    if not whole:
        return scan_lines(spark, rest)
    spread = scan_lines(spark, whole).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spread if not rest else scan_lines(spark, rest).unionByName(spread)


def pinned_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose scans cut the same files into the same splits whenever they run.

    Spark sizes splits by the cores that are live when a scan starts. Here that number is
    set once, so a second scan deals out the same row ids, though executors came or went
    in between. All other settings are those of ``spark``, which is left as it is.
    """
    pinned = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            pinned.conf.set(key, value)
    if pinned.conf.get("spark.sql.files.minPartitionNum", None) is None:
        cores = pinned.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism
        pinned.conf.set("spark.sql.files.minPartitionNum", str(max(int(cores), 1)))
    return pinned


def tag_source_file(lines: DataFrame, file_table: DataFrame) -> DataFrame:
    """Attach file_entry, file_index (the input's position) and file_order.

    The result runs in the session of ``file_table``, whatever session scans the lines.
    """
    added = [c for c in file_table.columns if c != "file_path"]
    return file_table.join(lines, "file_path").select("file_path", *[c for c in lines.columns if c != "file_path"], *added)


def read_log_lines(
    spark: SparkSession, inputs: str | list[str], name_prefix: str = DEFAULT_PREFIX,
) -> tuple[DataFrame, list[InputFile]]:
    """S1-S5 together: tagged raw lines and the ordered file list.

    The scan is pinned, so the lines may be read several times and keep their row ids.
    """
    files = list_inputs(spark, inputs, name_prefix)
    return tag_source_file(scan_spread(pinned_session(spark), files), files_frame(spark, files)), files


def union_inputs(frames: list[DataFrame]) -> DataFrame:
    """S4 for ready DataFrames: a bag union by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
