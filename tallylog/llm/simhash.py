"""SimHash near-dedup: exact links within a few bits, by vantage-point trees.

1. Fingerprints of the whole texts; equal fingerprints become one node.
2. Shards: vantage points drawn from the nodes; each node lives in the shard of
   its nearest vantage point (first on ties), large shards are cut into blocks.
3. A node within ``r`` bits of a member of another shard is at most ``2 r`` farther
   from that shard's vantage point than from its own (triangle inequality, twice),
   and its distance lies within ``r`` of the distances that the shard holds. Only
   such boundary-overlapping blocks get it as a query.
4. Within a block a vantage-point tree: the points of a tree node are parted by
   their exact distance from a vantage point, and a query at distance d follows the
   branches d - r to d + r. Leaves compare all that is left.
5. A task reports a spanning forest of the links that it finds, never all pairs, so
   its output is bounded by its nodes. Components come from the forests by repeated
   star contraction; the order of nodes makes the result unique.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylog.llm.common import constants, stage, table

SHINGLE_WORDS = 3
MAX_BITS = 3
#: Shingles that are hashed before their bits are counted, so that long texts need no more memory.
CHUNK = 1 << 14
#: Nodes in a block of a shard, and queries sent to it at once.
BLOCK = 1 << 15
#: Vantage points of the shards, at most; they are broadcast (8 bytes each).
MAX_SHARDS = 1 << 12
LEAF = 64


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of the word shingles of a text, as a signed integer; 0 without words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    n = max(1, len(tokens) - words + 1)
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        part = tokens[at:min(n, at + CHUNK) + words - 1]
        joined = [b" ".join(x) for x in zip(*(part[i:] for i in range(words)))] or [b" ".join(part)]
        hashes = np.array([digest(x, 42) for x in joined], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a text column as a long (its bits, signed).

    Lower-cases A-Z only; words are runs of anything but ASCII white space. A null
    text counts as empty: fingerprint 0.
    """
    udf = F.arrow_udf(lambda texts: pa.array([fingerprint(t.as_py(), words) for t in texts], pa.int64()), "long")
    return udf(text)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Forest:
    """Union-find over the rows of one task; the parent of a row is never larger than it."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """Link the pairs a[i], b[i]; returns those that joined two trees."""
        new: list[tuple[int, int]] = []
        while len(a):
            up = self.up
            while not np.array_equal(up, up[up]):
                up = up[up]
            self.up = up
            apart = up[a] != up[b]
            a, b = a[apart], b[apart]
            high, low = np.maximum(up[a], up[b]), np.minimum(up[a], up[b])
            _, first = np.unique(high, return_index=True)  # a root is hung under one smaller root at a time
            up[high[first]] = low[first]
            new += zip(a[first].tolist(), b[first].tolist())
        return new


def tree_links(points: np.ndarray, queries: np.ndarray, same: bool, r: int, cells: int = 1 << 20) -> list[tuple[int, int]]:
    """A spanning forest of the links between points and queries: pairs (point, query) of row numbers.

    ``same``: the queries are the points. ``cells``: pairs compared at once.
    """
    n = len(points)
    forest = Forest(n if same else n + len(queries))
    found: list[tuple[int, int]] = []
    work = [(np.arange(n), np.arange(len(queries)))]
    while work:
        p, q = work.pop()
        if not len(p) or not len(q):
            continue
        if len(p) <= LEAF:
            step = max(1, cells // len(p))
            for at in range(0, len(q), step):
                part = q[at:at + step]
                i, j = np.nonzero(_apart(points[p][:, None], queries[part][None, :]) <= r)
                a, b = p[i], part[j]
                if same:
                    a, b = a[a < b], b[a < b]
                found += forest.join(a, b if same else b + n)
            continue
        vantage = points[p[len(p) // 2]]
        dp, dq = _apart(points[p], vantage), _apart(queries[q], vantage)
        values = np.unique(dp)
        if len(values) == 1:  # nothing to part by: halve by place
            inside = q[np.abs(dq.astype(np.int16) - int(values[0])) <= r]
            half = len(p) // 2
            work += [(p[:half], inside), (p[half:], inside)]
            continue
        for v in values.tolist():
            work.append((p[dp == v], q[np.abs(dq.astype(np.int16) - v) <= r]))
    return found if same else [(a, b - n) for a, b in found]


def _vantage_points(nodes: DataFrame, count: int) -> np.ndarray:
    """At most MAX_SHARDS vantage points, one for each BLOCK of nodes: those of smallest hash."""
    n = min(MAX_SHARDS, -(-count // BLOCK))
    rows = nodes.select("fp").orderBy(F.xxhash64(F.lit("vantage"), "fp"), "fp").limit(n).collect()
    return np.array([x[0] for x in rows], np.int64).view(np.uint64)


def links(nodes: DataFrame, r: int = MAX_BITS) -> DataFrame:
    """Links that connect the distinct ``fp`` of ``nodes`` as all pairs within ``r`` bits do: ``a``, ``b`` (a < b)."""
    nodes = nodes.select("fp")
    count = nodes.count()
    vantage = _vantage_points(nodes, count)
    if not len(vantage):
        return nodes.select(F.col("fp").alias("a"), F.col("fp").alias("b"))

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            bits = fp.view(np.uint64)
            best, at = np.full(len(fp), 99, np.int64), np.zeros(len(fp), np.int32)
            for i, v in enumerate(vantage):
                d = _apart(bits, v)
                at[d < best] = i
                best = np.minimum(best, d)
            yield pa.RecordBatch.from_arrays([pa.array(fp), pa.array(at), pa.array(best)], names=["fp", "shard", "far"])

    homes = stage(nodes.mapInArrow(home, "fp long, shard int, far long"), "simhash-homes")
    # one row a shard, MAX_SHARDS at most: its size and the distances that it holds
    shape = {s: (n, lo, hi) for s, n, lo, hi in
             homes.groupBy("shard").agg(F.count(F.lit(1)), F.min("far"), F.max("far")).collect()}
    blocks = [-(-shape[s][0] // BLOCK) if s in shape else 1 for s in range(len(vantage))]
    block = F.pmod(F.xxhash64("fp"), F.get(constants(blocks, "int"), F.col("shard"))).cast("int")
    own = homes.withColumn("block", block)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Each pair of blocks is searched once: the later one (by shard, block) queries the earlier one.
        for batch in batches:
            fp, shard, far, part = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "shard", "far", "block"))
            bits = fp.view(np.uint64)
            for s, (_, lo, hi) in shape.items():
                d = _apart(bits, vantage[s]).astype(np.int64)
                reach = (shard > s) & (d <= far + 2 * r) & (d >= lo - r) & (d <= hi + r)
                for k in range(blocks[s]):
                    go = np.nonzero(reach | (shard == s) & (part > k))[0]
                    if len(go):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(go), s, np.int32)), pa.array(np.full(len(go), k, np.int32)),
                             pa.array(shard[go]), pa.array(part[go]), pa.array(fp[go])],
                            names=["shard", "block", "of", "part", "fp"])

    asked = stage(own.mapInArrow(route, "shard int, block int, of int, part int, fp long"), "simhash-asked")
    # a group: the points of one block, and the queries that another block sends it
    trees = own.select("shard", "block", "fp").join(
        asked.select("shard", "block", F.col("of").alias("by"), F.col("part").alias("by_part")).distinct(), ["shard", "block"])
    key = ["shard", "block", "of", "part"]

    def pairs(points: np.ndarray, queries: np.ndarray, same: bool) -> pa.Table:
        p, q = np.sort(points), np.sort(queries)
        got = tree_links(p.view(np.uint64), q.view(np.uint64), same, r)
        a = p[[x for x, _ in got]] if got else p[:0]
        b = q[[y for _, y in got]] if got else q[:0]
        return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    def within(group: pa.Table) -> pa.Table:
        fp = group.column("fp").to_numpy()
        return pairs(fp, fp, True)

    def across(left: pa.Table, right: pa.Table) -> pa.Table:
        return pairs(left.column("fp").to_numpy(), right.column("fp").to_numpy(), False)

    inner = own.groupBy("shard", "block").applyInArrow(within, "a long, b long")
    outer = trees.groupBy("shard", "block", "by", "by_part").cogroup(asked.groupBy(*key)).applyInArrow(across, "a long, b long")
    return inner.unionByName(outer)


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node that each node of ``edges`` (a, b) reaches.

    Rounds of large-star and small-star; each round's edges are written to the
    shared folder. Every star is bounded by the links of its centre and is
    aggregated, not collected.
    """
    edges = stage(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        edges = stage(small, "cc")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(prints: DataFrame, r: int = MAX_BITS) -> DataFrame:
    """``fp``, ``root``, ``component_id`` for each distinct ``fp`` of ``prints`` (doc_id, fp).

    root is the smallest fingerprint of the component, component_id the smallest
    doc_id that is reachable over links of at most ``r`` bits; null where all
    reachable rows have a null doc_id.
    """
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = stage(components(links(nodes, r)), "simhash-roots")
    named = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", "root")
    # only nodes that have a link are grouped; the others are their own component
    linked = named.filter(F.col("root").isNotNull())
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    return (linked.join(least, "root").select("fp", "root", "component_id")
            .unionByName(named.filter(F.col("root").isNull())
                         .select("fp", F.col("fp").alias("root"), F.col("least").alias("component_id"))))


def simhash(docs: DataFrame, words: int = SHINGLE_WORDS, r: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of each row of ``docs`` (doc_id, text).

    Repeated rows come as often as they are there. Empty texts share fingerprint 0
    and so one component. An empty table gives no rows.
    """
    prints = stage(docs.select("doc_id", fingerprint_column(F.col("text"), words).alias("fp")), "simhash-prints")
    found = near_duplicates(prints, r)
    return (prints.join(found, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, r: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, any others) that stay: one of each component, that of its smallest doc_id.

    Rows that share that doc_id: the one that is first in the staged table. A
    component without any doc_id keeps its first row. Columns named __fp and __row
    are not allowed.
    """
    rows = stage(docs.withColumn("__fp", fingerprint_column(F.col("text"), words))
                 .withColumn("__row", F.monotonically_increasing_id()), "simhash-rows")
    prints = rows.select("doc_id", F.col("__fp").alias("fp"), "__row")
    found = near_duplicates(prints, r)
    chosen = (prints.join(found, "fp").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
              .groupBy("root").agg(F.min("__row").alias("__row")).select("__row"))
    return rows.join(chosen, "__row", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components of all ``documents``: 3-word shingles, at most 3 bits."""
    return simhash(table(spark, sf_dir, "documents").select("doc_id", "text"))
