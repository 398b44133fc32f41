"""Approximate nearest neighbours by vantage-point trees, one in each shard.

The measure is the inner product. With M the largest norm, a vector x gets one
more component, sqrt(M^2 - |x|^2), and a query a 0 there; the Euclidean distance
then orders as the inner product does, and the triangle inequality holds.

1. Cells: each vector lives with the nearest of a bounded number of pivots. A cell
   is cut into shards of SHARD vectors, so a large cell is not one task.
2. Each shard gets a vantage-point tree: a node splits its vectors at the median of
   their distances from a vantage point and keeps the range of distances of either
   side. The trees are written, as arrays, to the shared folder.
3. A query first searches its own cell, which gives a bound on its k-th distance. It
   then goes to each cell, and in a tree to each branch, whose least possible distance
   by the triangle inequality, times ``factor``, is not above that bound.
   ``factor`` 1 is exact; a larger one leaves out branches that could only just matter.
   ``choose_factor`` takes the largest that keeps a given recall on a sample of queries.
4. A shard scores the vectors of the leaves on the original vectors in double
   precision; the best of all shards are merged.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallylog.llm.common import constants, stage, table

#: Vectors in a shard: what one task holds (8 MB at 64 components).
SHARD = 1 << 14
#: Queries that a task searches in a shard at once: as many as the shard has vectors, so moving the tree costs no more than moving them.
QUERIES = SHARD
#: Queries whose ways are found at once: one flag for each and each shard.
WAYS = 256
#: Pivots, at most; they are sent to all tasks.
MAX_PIVOTS = 1024
LEAF = 64
#: Wholly equal rows beyond this number are grouped before they are dealt to shards.
COPIES = SHARD // 4
#: The production factor. 1 is exact; at 5, clustered vectors of unlike norms or of low rank lost a fifth of their neighbours or more.
FACTOR = 1.0
#: The factors that ``choose_factor`` tries, and the queries that it tries them on.
FACTORS = (8.0, 5.0, 3.0, 2.0, 1.5)
SAMPLE = 200
#: What rounding may add to a distance, times the largest norm.
SLACK = 1e-6
#: What the order of summing may add to an inner product, times both norms: far above 2^-53 a component.
ROUNDING = 1e-9


def usable(embedding: str) -> Column:
    """Is the vector there, finite in all components, and not zero?"""
    e = F.col(embedding)
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return e.isNotNull() & ~bad & F.exists(e, lambda x: x != 0)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _lift(x: np.ndarray, radius: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(0.0, radius**2 - np.einsum("ij,ij->i", x, x)))
    return np.hstack([x, rest[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of each row of ``a`` from each row of ``b``."""
    sq = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(sq, 0.0))


class Tree:
    """A vantage-point tree over the rows of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, radius: float):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.radius = ids[order], vectors[order], radius
        points = _lift(self.vectors, radius)
        self.nodes: list[tuple] = []  # (rows,) or (vantage, near, near range, far, far range)
        self._build(points)

    def __getstate__(self) -> dict:
        """As floats of 32 bits where they hold the same values."""
        with np.errstate(over="ignore"):
            small = self.vectors.astype(np.float32)
        return {**self.__dict__, "vectors": small if np.array_equal(small, self.vectors) else self.vectors}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.vectors = self.vectors.astype(np.float64)

    def _build(self, points: np.ndarray) -> None:
        todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(points)), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            at = len(self.nodes)
            if parent >= 0:
                self.nodes[parent][1 + 2 * side] = at
            if len(rows) <= LEAF:
                self.nodes.append([rows])
                continue
            centre = points[rows].mean(0)
            vantage = points[rows[np.argmax(_distances(points[rows], centre[None])[:, 0])]]
            d = _distances(points[rows], vantage[None])[:, 0]
            by = np.argsort(d, kind="stable")
            near, far = by[:len(by) // 2], by[len(by) // 2:]  # by place, so equal vectors part as well
            self.nodes.append([vantage, None, (d[near].min(), d[near].max()), None, (d[far].min(), d[far].max())])
            todo += [(rows[far], at, 1), (rows[near], at, 0)]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int, factor: float) -> list[tuple[int, int, float]]:
        """The best ``k`` of each query as (place of the query, vec_id, score), none beyond its ``bounds`` (distances)."""
        n, given = len(queries), bounds
        lifted = np.hstack([queries, np.zeros((n, 1))])
        norm = np.einsum("ij,ij->i", queries, queries)
        rounding = ROUNDING * self.radius * np.sqrt(norm)
        best_score, best_row = np.full((n, k), -np.inf), np.full((n, k), len(self.ids))
        by_id = np.append(self.ids, np.iinfo(np.int64).max)  # the ids of rows; the last stands for none
        bounds = bounds.copy()
        todo = [(0, np.arange(n), np.zeros(n))]
        while todo:
            at, q, least = todo.pop()
            q = q[least * factor <= bounds[q] + SLACK * self.radius]
            if not len(q):
                continue
            node = self.nodes[at]
            if len(node) == 1:
                rows = node[0]
                # a fast product first: queries whose k-th score nothing here can reach, ties included, are done
                q = q[(queries[q] @ self.vectors[rows].T).max(1) >= best_score[q, k - 1] - rounding[q]]
                if not len(q):
                    continue
                score = np.einsum("qd,nd->qn", queries[q], self.vectors[rows])
                score[self.ids[rows][None, :] == query_ids[q][:, None]] = -np.inf
                all_score = np.hstack([best_score[q], score])
                all_row = np.hstack([best_row[q], np.broadcast_to(rows, score.shape)])
                order = np.lexsort((by_id[all_row], -all_score), axis=-1)[:, :k]
                best_score[q] = np.take_along_axis(all_score, order, 1)
                best_row[q] = np.take_along_axis(all_row, order, 1)
                worst = best_score[q, k - 1]
                squared = norm[q] + self.radius**2 - 2 * worst
                bounds[q] = np.minimum(bounds[q], np.where(np.isfinite(worst), np.sqrt(np.maximum(0.0, squared)), np.inf))
                continue
            vantage, near, (a, b), far, (c, d) = node
            dist = _distances(lifted[q], vantage[None])[:, 0]
            sides = [(near, np.maximum(np.maximum(a - dist, dist - b), 0.0)), (far, np.maximum(np.maximum(c - dist, dist - d), 0.0))]
            closer_far = int((sides[1][1] < sides[0][1]).sum() * 2 > len(q))
            for child, least in (sides if closer_far else sides[::-1]):  # the closer side is taken next
                todo.append((child, q, least))
        distance = np.sqrt(np.maximum(0.0, norm[:, None] + self.radius**2 - 2 * np.where(np.isfinite(best_score), best_score, 0.0)))
        found = np.isfinite(best_score) & (distance <= given[:, None] + SLACK * self.radius)
        place, rows = np.nonzero(found)[0], best_row[found]
        score = np.zeros(len(rows))
        for i in range(queries.shape[1]):  # entry by entry from the first, as anyone else would add them up
            score += queries[place, i] * self.vectors[rows, i]
        return list(zip(place.tolist(), self.ids[rows].tolist(), score.tolist()))


def _search_groups(queries: DataFrame, index: DataFrame, k: int, factor: float) -> DataFrame:
    """Search: ``queries`` (shards, part, query_id, vector, bound) against ``index`` (shard, tree); query_id, vec_id, score.

    A query is one row with a list of shards, and is copied to them on its way to the search only.
    """
    pairs = queries.select(F.explode("shards").alias("shard"), F.col("part").alias("for_part")).distinct()
    trees = index.join(pairs, "shard").select("shard", "for_part", "tree")
    queries = queries.select(F.explode("shards").alias("shard"), "part", "query_id", "vector", "bound")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        ids = right.column("query_id").to_numpy()
        if left.num_rows and right.num_rows:
            tree: Tree = pickle.loads(left.column("tree")[0].as_py())
            out = tree.search(ids, _matrix(right.column("vector")), right.column("bound").to_numpy(), k, factor)
        return pa.table({"query_id": pa.array(ids[[p for p, _, _ in out]] if out else ids[:0]),
                         "vec_id": pa.array([v for _, v, _ in out], pa.int64()), "score": pa.array([s for _, _, s in out], pa.float64())})

    return trees.groupBy("shard", "for_part").cogroup(queries.groupBy("shard", "part")).applyInArrow(
        search, "query_id long, vec_id long, score double")


def _top(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _few_copies(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` (vec_id, vector) without the copies of a wholly equal row that can be in no result: the ``k`` + 1st and on.

    Only rows with over COPIES copies are grouped, so that no shard is filled by one row.
    """
    mark = F.xxhash64("vec_id", "vector").alias("mark")
    many = stage(rows.select(mark).groupBy("mark").count().filter(F.col("count") > COPIES).select("mark"), "ann-copied")
    if many.isEmpty():
        return rows
    marked = rows.select(mark, "vec_id", "vector")
    few = (marked.join(many, "mark", "left_semi").groupBy("vec_id", "vector").agg(F.count(F.lit(1)).alias("n"))
           .select("vec_id", "vector", F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k)).cast("int")))).select("vec_id", "vector"))
    return marked.join(many, "mark", "left_anti").select("vec_id", "vector").unionByName(few)


RESULT = "query_id long, rank int, vec_id long, score double"


def _norm() -> Column:
    return F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))


def _vectors(df: DataFrame, id_name: str) -> DataFrame:
    """The usable rows of (vec_id, embedding) as an id and a vector: of floats, if the table holds floats, else of doubles."""
    kind = "array<float>" if df.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    return df.filter(usable("embedding") & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias(id_name), F.col("embedding").cast(kind).alias("vector"))


def _kind(df: DataFrame) -> str:
    return df.schema["vector"].dataType.simpleString()


@dataclass
class Index:
    """The trees (shard, tree; staged), and what queries are routed by: one entry a pivot at most."""

    trees: DataFrame
    radius: float
    length: int
    pivots: np.ndarray
    shape: dict[int, tuple[int, float, float]]  # of a cell: vectors, nearest and farthest from its pivot
    shards: list[int]  # of a cell: its number of shards

    def fits(self) -> Column:
        return _fits(self.length)

    @property
    def occupied(self) -> np.ndarray:
        return np.array([c for c in range(len(self.pivots)) if c in self.shape])


def _fits(length: int) -> Column:
    return (F.size("vector") == length) & (_norm() < float("inf"))


def build(vectors: DataFrame, k: int = 20) -> Index | None:
    """The index of ``vectors`` for searches of up to ``k``; None where no row takes part (see ``search``)."""
    rows = _vectors(vectors, "vec_id")
    common = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    length = common.d if common else 0
    rows = _few_copies(rows.filter(_fits(length)), k)
    count, squared = rows.agg(F.count(F.lit(1)), F.max(_norm())).first()
    if not count:
        return None
    radius = float(np.sqrt(squared)) * (1 + 1e-12)

    # pivots: the vectors of smallest hash, a bounded number
    n_pivots = min(MAX_PIVOTS, max(1, count // SHARD))
    chosen = rows.select(F.xxhash64("vec_id", F.lit("pivot")).alias("h"), "vec_id", "vector").orderBy("h", "vec_id").limit(n_pivots).collect()
    pivots = _lift(np.array([r.vector for r in chosen]), radius)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            d = _distances(_lift(_matrix(b.column("vector")), radius), pivots)
            cell = d.argmin(1)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("vector"), pa.array(cell.astype(np.int32)),
                                              pa.array(d[np.arange(len(d)), cell])], names=["vec_id", "vector", "cell", "far"])

    homes = stage(rows.mapInArrow(nearest, f"vec_id long, vector {_kind(rows)}, cell int, far double"), "ann-homes")
    # one row a cell, MAX_PIVOTS at most
    shape = {c: (n, lo, hi) for c, n, lo, hi in homes.groupBy("cell").agg(F.count(F.lit(1)), F.min("far"), F.max("far")).collect()}
    shards = [-(-shape[c][0] // SHARD) if c in shape else 0 for c in range(len(pivots))]
    first = np.concatenate([[0], np.cumsum(shards)]).tolist()
    cut = F.pmod(F.xxhash64("vec_id", "vector"), F.get(constants(shards, "int"), F.col("cell"))).cast("int")
    placed = homes.withColumn("shard", F.get(constants(first, "int"), F.col("cell")) + cut)

    def plant(group: pa.Table) -> pa.Table:
        tree = Tree(group.column("vec_id").to_numpy(), _matrix(group.column("vector")), radius)
        return pa.table({"shard": group.column("shard").slice(0, 1), "tree": pa.array([pickle.dumps(tree, 5)], pa.binary())})

    trees = stage(placed.select("shard", "vec_id", "vector").groupBy("shard").applyInArrow(plant, "shard int, tree binary"), "ann-index")
    return Index(trees, radius, length, pivots, shape, shards)


def find(index: Index, queries: DataFrame, k: int = 20, factor: float = FACTOR) -> DataFrame:
    """The ``k`` vectors of the index nearest to each of ``queries``, as ``search`` returns them."""
    radius, pivots = index.radius, index.pivots
    asked = _vectors(queries, "query_id").filter(index.fits()).groupBy("query_id").agg(F.min("vector").alias("vector"))

    # a query's own cell is the occupied one of the nearest pivot
    occupied = index.occupied
    per_cell = [index.shards[c] for c in occupied]
    lows, highs = (np.array([index.shape[c][i] for c in occupied]) for i in (1, 2))

    def route(own: bool):
        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                x = _matrix(b.column("vector"))
                d = _distances(np.hstack([x, np.zeros((len(x), 1))]), pivots[occupied])
                home = d.argmin(1)
                is_home = np.arange(len(occupied))[None, :] == home[:, None]
                if own:
                    go, bound = is_home, np.full(len(x), np.inf)
                else:
                    bound = b.column("bound").to_numpy(zero_copy_only=False)
                    # the cell's distances from its pivot, by the triangle inequality
                    least = np.maximum(np.maximum(lows[None, :] - d, d - highs[None, :]), 0.0)
                    go = ~is_home & (least * factor <= bound[:, None] + SLACK * radius)
                for start in range(0, len(x), WAYS):
                    reach = np.repeat(go[start:start + WAYS], per_cell, axis=1)  # shards are numbered cell by cell
                    ends = np.concatenate([[0], np.cumsum(reach.sum(1))])
                    ways = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.nonzero(reach)[1], pa.int32()))
                    some = b.slice(start, WAYS)
                    yield pa.RecordBatch.from_arrays(
                        [ways, some.column("query_id"), some.column("vector"), pa.array(bound[start:start + WAYS])],
                        names=["shards", "query_id", "vector", "bound"])
        return apply

    asked = stage(asked, "ann-queries")
    parts = max(1, -(-asked.count() // QUERIES))
    part = F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int")
    routed = f"shards array<int>, query_id long, vector {_kind(asked)}, bound double"
    home_found = stage(_top(_search_groups(stage(asked.mapInArrow(route(True), routed).withColumn("part", part), "ann-asked"),
                                           index.trees, k, factor), k), "ann-own")
    # the k-th distance so far bounds what is still to find
    kth = home_found.filter(F.col("rank") == k).select("query_id", "score")
    so_far = F.sqrt(F.greatest(_norm() + radius**2 - 2 * F.col("score"), F.lit(0.0)))
    bounded = asked.join(kth, "query_id", "left").select(
        "query_id", "vector", F.when(F.col("score").isNotNull(), so_far).otherwise(float("inf")).alias("bound"))
    others = _search_groups(stage(bounded.mapInArrow(route(False), routed).withColumn("part", part), "ann-asked"), index.trees, k, factor)
    best = _top(home_found.select("query_id", "vec_id", "score").unionByName(others), k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, factor: float = FACTOR) -> DataFrame:
    """The ``k`` vectors of ``vectors`` (vec_id, embedding) nearest to each of ``queries`` (same columns).

    Returns query_id, rank (int, from 1), vec_id, score: largest inner product first,
    ties to the smaller vec_id; fewer rows where there are fewer candidates. A vector
    that is null, zero or holds a null or non-finite component takes no part, nor does
    one with a null id, one whose length is not the commonest (the longer one on a tie), or
    one whose squared norm a double cannot hold. A query's own id is no candidate.
    Repeated ids: rows of ``queries`` with one id are searched once (the first by
    value); rows of ``vectors`` that share an id are candidates each. Empty tables give no rows.
    Other columns, of any name, are not read; there are no texts.
    """
    index = build(vectors, k)
    if index is None:
        return vectors.sparkSession.createDataFrame([], RESULT)
    return find(index, queries, k, factor)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of the rows of ``exact`` (query_id, vec_id) that ``found`` holds; 1 where there are none."""
    pairs = ["query_id", "vec_id"]
    n = exact.count()
    return exact.select(*pairs).distinct().join(found.select(*pairs).distinct(), pairs, "left_semi").count() / n if n else 1.0


def choose_factor(index: Index, queries: DataFrame, k: int = 20, wanted: float = 0.95, sample: int = SAMPLE) -> float:
    """The largest of FACTORS at which a sample of ``queries`` finds the ``wanted`` share of its true neighbours; 1 if none does.

    The sample, ``sample`` queries of smallest hash, is searched exactly and then by each
    factor in turn, the one that prunes most first.
    """
    some = stage(queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample), "ann-sample")
    exact = stage(find(index, some, k, 1.0), "ann-exact")
    for factor in FACTORS:
        if recall(find(index, some, k, factor), exact) >= wanted:
            return factor
    return 1.0


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all ``embeddings`` to each whose vec_id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


#: The exact answer, which factor 1 gives.
ORACLE_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
             AND len([x FOR x IN embedding IF x <> 0]) > 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e) AS score FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""
