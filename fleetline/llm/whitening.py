"""Embedding whitening by QDWH spectral divide and conquer (operator 13).

Method.  Entries become integers ``floor(64 c) + 1000000``.  The covariance is
taken over the distinct integer vectors: exact sums, then products of vectors
centred at the rounded mean (whole numbers, so doubles add them exactly while
a total stays below 2^53), corrected by the mean's remainder.  ``spectral``
splits the covariance into its components; rows are projected on the leading
ones and divided by the square root of the eigenvalue.

Scale.  One shuffle (the distinct vectors, reduced before it) and three passes;
every task sends at most d (d + 1) / 2 numbers.  The driver holds the d x d
covariance, and tasks receive d x ``components`` numbers: d is at most
``MAX_DIMENSIONS``, so 134 MB and 0.5 MB.

Cases.  Null vectors and vectors with null, NaN or infinite entries are left
out, and so are empty vectors and those of another length than most (ties: the
longer length).  64 c is held within +-2^61.  Repeated rows and null ids keep a
row each.  Components without variance (an eigenvalue below d epsilon times
the largest) cannot be scaled to one and are left out, so a table of equal
vectors gives no rows; nor does an empty table.  A ``deviation`` beyond a long
is null.  A vector's sign is chosen by its largest entry.  Extra columns are
not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetline.llm import spectral
from fleetline.llm.common import materialize

COMPONENTS = 16
STEPS, OFFSET = 64, 1_000_000
MAX_DIMENSIONS = 4096
BLOCK_ROWS = 4096
LIMIT = float(2 ** 61)
SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def usable(vector: Column) -> Column:
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda c: F.coalesce(
        ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))


def integers(vector: Column) -> Column:
    """Every entry as ``floor(64 c) + 1000000``."""
    return F.transform(vector, lambda c: F.floor(F.greatest(F.lit(-LIMIT), F.least(
        F.lit(LIMIT), c.cast("double") * float(STEPS)))).cast("long") + F.lit(OFFSET).cast("long"))


def common_length(vectors: DataFrame, column: str) -> int:
    """The most frequent length of the usable vectors; 0 without any."""
    lengths = vectors.filter(usable(F.col(column))).groupBy(F.size(column).alias("d")).count()
    top = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    if top is None:
        return 0
    if top["d"] > MAX_DIMENSIONS:
        raise ValueError(f"vectors of {top['d']} dimensions; the covariance is held for at most {MAX_DIMENSIONS}")
    return top["d"]


def blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """Batches of at most ``BLOCK_ROWS`` rows with their vectors as a matrix."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            yield part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d), part


def whole_sum(x: np.ndarray) -> np.ndarray:
    """Column sums without overflow."""
    reach = int(np.abs(x).max()) * len(x)
    return x.sum(axis=0) if reach < 2 ** 62 else x.astype(object).sum(axis=0)


def totals(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and their exact sum in every dimension."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = 0, np.zeros(d, object)
        for x, _ in blocks(batches, d):
            count += len(x)
            sums = sums + whole_sum(x)
        if count:
            yield pa.RecordBatch.from_pydict({
                "dimension": pa.array(range(d), pa.int32()), "n": pa.array([count] * d, pa.int64()),
                "total": pa.array([str(s) for s in sums], pa.string())})

    parts = fit.mapInArrow(add, "dimension int, n long, total string")
    rows = (parts.groupBy("dimension").agg(F.sum("n").alias("n"), F.sum(
        F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("dimension").collect())   # d rows
    return (rows[0]["n"] if rows else 0), [int(r["total"]) for r in rows]


def products(frame: DataFrame, width: int, of) -> np.ndarray:
    """Sum over all rows of the outer products of ``of(batches)``' matrices."""
    upper = np.triu_indices(width)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((width, width)), False
        for y in of(batches):
            total += y.T @ y
            some = True
        if some:
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(upper[0], pa.int32()), "j": pa.array(upper[1], pa.int32()),
                "m": pa.array(total[upper], pa.float64())})

    out = np.zeros((width, width))
    summed = frame.mapInArrow(multiply, "i int, j int, m double").groupBy("i", "j").agg(F.sum("m").alias("m"))
    for row in summed.collect():                                   # width (width + 1) / 2 rows
        out[row["i"], row["j"]] = out[row["j"], row["i"]] = row["m"]
    return out


@dataclass
class Whitening:
    """What a row needs: ``centre`` whole numbers near the mean, ``remainder``
    of n times the mean, vectors as columns, eigenvalues, shares of variance."""
    n: int
    centre: np.ndarray
    remainder: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre).astype(float) - self.remainder.astype(float) / self.n

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact."""
        y = x - self.centre
        reach = self.n * (int(np.abs(y).max()) + 1)
        if reach * reach * x.shape[1] < 2 ** 62:
            return ((self.n * y - self.remainder.astype(np.int64)) ** 2).sum(axis=1).tolist()
        y = y.astype(object) * self.n - self.remainder
        return [s if s < 2 ** 63 else None for s in (y * y).sum(axis=1)]


def fitted(fit: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    """Leading components of the distinct vectors ``fit`` (x)."""
    n, sums = totals(fit, d)
    if not n:
        return None
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    remainder = np.array([s - n * int(c) for s, c in zip(sums, centre)], object)
    shift = np.array([r / n for r in remainder])
    moments = products(fit, d, lambda batches: ((x - centre).astype(float) for x, _ in blocks(batches, d)))
    covariance = moments / n - np.outer(shift, shift)
    values, vectors = spectral.components(covariance)
    top = max(float(values[0]), 0.0)
    keep = int((values[:components] > d * spectral.EPS * top).sum()) if top > 0 else 0
    return Whitening(n, centre, remainder, vectors[:, :keep], values[:keep],
                     values[:keep] / np.trace(covariance) if keep else values[:0])


def identity_error(fit: DataFrame, d: int, model: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity."""
    width = model.vectors.shape[1]
    if not width:
        return 0.0
    shared = fit.sparkSession.sparkContext.broadcast(model)
    # A last column of ones gives the sums, hence the means.
    moments = products(fit, width + 1, lambda batches: (
        np.hstack([shared.value.project(x), np.ones((len(x), 1))]) for x, _ in blocks(batches, d))) / model.n
    mean = moments[:width, width]
    covariance = moments[:width, :width] - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(width)).max())


def whiten(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per usable vector and component; ``vectors`` has vec_id and
    ``column``."""
    spark = vectors.sparkSession
    d = common_length(vectors, column)
    if not d:
        return spark.createDataFrame([], SCHEMA)
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).alias("v"))
            .filter(usable(F.col("v")) & (F.size("v") == d)).select("vec_id", integers(F.col("v")).alias("x")))
    fit = materialize(rows.select("x").distinct(), "whitening-fit")
    model = fitted(fit, d, components)
    error = identity_error(fit, d, model)
    shared = spark.sparkContext.broadcast(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        width = model.vectors.shape[1]
        for x, part in blocks(batches, d):
            each = np.repeat(np.arange(len(x)), width)
            yield pa.RecordBatch.from_pydict({
                "vec_id": part.column("vec_id").take(pa.array(each)),
                "component": pa.array(np.tile(np.arange(1, width + 1), len(x)), pa.int32()),
                "n": pa.array(np.full(len(each), model.n), pa.int64()),
                "deviation": pa.array(model.deviations(x), pa.int64()).take(pa.array(each)),
                "whitened": pa.array(model.project(x).ravel(), pa.float64()),
                "explained": pa.array(np.tile(model.explained, len(x)), pa.float64()),
                "identity_error": pa.array(np.full(len(each), error), pa.float64())})

    return rows.mapInArrow(project, SCHEMA)
