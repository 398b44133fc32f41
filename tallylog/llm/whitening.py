"""Embedding whitening over distinct vectors.

1. Vectors become integer vectors x (a scaled floor), and equal x are grouped with
   their number. The fit list is each distinct x, weighted by one or by that number.
2. Two passes over the distinct vectors give the weighted sums (exact integers) and the
   centred products: a task multiplies its centred block by itself (GEMM) and returns one
   matrix, which Spark adds up cell by cell.
3. The driver takes the eigenvectors of the covariance, and each distinct vector is
   whitened once.
4. The results are joined back to the rows by x. A vector that many rows share is
   split off: those with over one row in HOT_SHARE are HOT_SHARE at most and are
   broadcast, so their rows are not moved. No other key holds more rows than that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylog.llm.common import stage, table

COMPONENTS = 4
SCALE = 256
HOT_SHARE = 1024
LONGEST = (1 << 63) - 1
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def usable(embedding: str) -> Column:
    """Is the vector there, and finite in all entries?"""
    e = F.col(embedding)
    return e.isNotNull() & (F.size(e) > 0) & ~F.exists(e, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _weights(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("weight").to_numpy(zero_copy_only=False)


def _added(df: DataFrame, of: Callable[[pa.RecordBatch], np.ndarray]) -> dict[int, float]:
    """The cells of ``of(batch)`` added up over all batches: within a task first, then by cell."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                total = of(b) if total is None else total + of(b)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(len(total))), "value": pa.array(total)})

    return dict(map(tuple, df.mapInArrow(apply, "cell long, value double").groupBy("cell").agg(F.sum("value")).collect()))


def _exact_sums(distinct: DataFrame, d: int) -> list[int]:
    """The weighted sum of each dimension, whatever its size."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, w = _matrix(b.column("x"), np.int64), _weights(b)
                if float(np.abs(x.astype(float)).max()) * float(w.sum()) >= 2.0**62:  # beyond 64 bits: Python's integers
                    x, w = x.astype(object), w.astype(object)
                sums = [str(s) for s in (x * w[:, None]).sum(0)]
                yield pa.RecordBatch.from_pydict({"dimension": pa.array(np.arange(d, dtype=np.int32)), "part": pa.array(sums)})

    added = distinct.mapInArrow(apply, "dimension int, part string").groupBy("dimension").agg(F.sum(F.col("part").cast("decimal(38,0)")))
    sums = dict(map(tuple, added.collect()))
    return [int(sums[i]) for i in range(d)]


@dataclass
class Whitener:
    """``n`` fit vectors with ``sums``; unit eigenvectors (rows) of their covariance with ``values``, falling."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def apart(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly: integers of 64 bits, or Python's where these do not hold them."""
        if float(np.abs(x.astype(float)).max(initial=0)) * self.n + max(map(abs, self.sums)) < 2.0**62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (self.apart(x).astype(float) / self.n) @ self.vectors.T / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The squares of ``apart`` added up, exactly; None beyond a long."""
        apart = self.apart(x)
        about = (apart.astype(float) ** 2).sum(1)
        if about.max(initial=0) < 2.0**62:
            return (apart.astype(np.int64) ** 2).sum(1).tolist()
        exact = [sum(v * v for v in row.tolist()) if a < 2.0**64 else LONGEST + 1 for row, a in zip(apart, about)]
        return [s if s <= LONGEST else None for s in exact]


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """The usable rows as vec_id, x (array<long>): floor(scale * entry) of each entry; rows of an uncommon length are left out."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long"))
    rows = vectors.filter(usable("embedding")).select("vec_id", x.alias("x"))
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("x") == (common.d if common else 0))


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Fit on ``distinct`` (x, weight); None where it is empty or has no spread.

    Components whose eigenvalue is zero, to rounding, cannot be whitened and are left out.
    """
    n, d = distinct.agg(F.sum("weight"), F.max(F.size("x"))).first()
    if not n:
        return None
    model = Whitener(n, _exact_sums(distinct, d), np.zeros((0, d)), np.zeros(0), 0.0)

    def products(b: pa.RecordBatch) -> np.ndarray:
        centred = model.apart(_matrix(b.column("x"), np.int64)).astype(float) / model.n
        return ((_weights(b)[:, None] * centred).T @ centred).ravel()

    cells = _added(distinct, products)
    covariance = np.array([cells[i] for i in range(d * d)]).reshape(d, d) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > max(values.max(), 0.0) * d * np.finfo(float).eps]
    if not len(order):
        return None
    return Whitener(n, model.sums, vectors.T[order], values[order], float(np.trace(covariance)))


def identity_error(whitened: DataFrame, n: int, k: int) -> float:
    """The largest absolute entry of the covariance of ``whitened`` (w, weight) minus the identity; centred first."""
    sums = _added(whitened, lambda b: (_weights(b)[:, None] * _matrix(b.column("w"), float)).sum(0))
    mean = np.array([sums[i] for i in range(k)]) / n

    def products(b: pa.RecordBatch) -> np.ndarray:
        centred = _matrix(b.column("w"), float) - mean
        return ((_weights(b)[:, None] * centred).T @ centred).ravel()

    cells = _added(whitened, products)
    return float(np.abs(np.array([cells[i] for i in range(k * k)]).reshape(k, k) / n - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, by_count: bool = False) -> DataFrame:
    """Whiten ``vectors`` (vec_id, embedding) by the first ``components`` of their covariance.

    Returns, for each row that takes part and each component (from 1, by falling
    eigenvalue): vec_id, component, n (sum of the fit weights), deviation (sum over
    dimensions of (n*x - S)^2; null beyond a long), whitened, explained, identity_error.
    Fit weights are one for each distinct x or, with ``by_count``, the number of its rows.
    A vector that is null, empty or holds a null or non-finite entry takes no part, nor
    does one whose length is not the commonest (the longer one on a tie); scaled entries
    beyond a long stop at its ends. Repeated and null ids: each row has its results.
    Components of eigenvalue zero have no rows, so equal vectors, one vector and an empty
    table give none. Other columns, of any name, are not read; no text is.

    A task holds a block of rows and a matrix of d * d, the driver the latter.
    """
    spark = vectors.sparkSession
    rows = integers(vectors, scale)
    weight = F.col("copies") if by_count else F.lit(1).cast("long")
    distinct = stage(rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies")).withColumn("weight", weight), "whitening-distinct")
    model = fit(distinct, components)
    if model is None:
        return spark.createDataFrame([], RESULT)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column("x"), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column("x"), b.column("copies"), b.column("weight"), pa.array(model.deviation(x), pa.int64()),
                     pa.array(list(model.whiten(x)), pa.list_(pa.float64()))], names=["x", "copies", "weight", "deviation", "w"])

    once = stage(distinct.mapInArrow(apply, "x array<long>, copies long, weight long, deviation long, w array<double>"), "whitening-once")
    k = len(model.values)
    error = identity_error(once.select("w", "weight"), model.n, k)

    many = F.col("copies") > F.lit(once.agg(F.sum("copies")).first()[0] / HOT_SHARE)
    result = ["vec_id", "deviation", "w"]
    hot = F.broadcast(once.filter(many).select("x", "deviation", "w"))
    back = (rows.join(hot, "x").select(*result)
            .unionByName(rows.join(hot, "x", "left_anti").join(once.filter(~many).select("x", "deviation", "w"), "x").select(*result)))
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    return back.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        F.col("vec_id").cast("long").alias("vec_id"), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``embeddings`` by the first four components of their distinct vectors."""
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
