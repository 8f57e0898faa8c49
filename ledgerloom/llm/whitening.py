"""Embedding whitening by shifted Cholesky QR.

The principal components of the rows are the right singular vectors of the centred rows, and these are the right
singular vectors of the factor R of a QR decomposition of the rows. R comes from Gram passes: each pass sums the products of
the rows, orthogonalised so far by triangular solves, over all tasks; the Cholesky factor of the sum is the next factor.
A small shift keeps the factor defined where rows lack some direction. Passes go on until the products show orthonormal
columns; the factors are multiplied up, and a singular value decomposition of R gives the components.

Every pass reads the distinct rows from a written table and returns one d x d matrix a task, summed by Spark; only the summed matrix
(d is the length of a vector) reaches the driver. Rows are never gathered.

Entries are taken on a grid: ``x = floor(scale * c)`` as a whole number, so that distinct rows, their number and their sums
are exact. All sums of squares of a row's distance from the mean are exact too.

Defined results. A vector that is null or empty, or holds a null, a NaN, an infinity or an entry whose grid value is beyond 2**53, takes no
part and gives no row; so do vectors of another length than most rows have (of two equally common lengths the
longer one counts). Repeated vectors count once in the fit, every row of them gets its own results; null and repeated ids are kept
as they are. Directions without variance give no component, so a table of one distinct vector, or an empty one,
gives no row. ``deviation`` is null where it doesn't fit into a long. Of components with equal variance any orthonormal choice is right.
Only the id and the vector are read from the input; the caller names the columns, others don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import written

SCALE = 256
PASSES = 5                   # Gram passes at most; three or four are the rule
ORTHONORMAL = 1e-10          # departure of the products from the identity below which the columns count as orthonormal
LARGEST = float(1 << 53)     # beyond it a grid value is no longer exact as a double


@dataclass
class Whitening:
    """Components of a table: ``sums`` of the grid values of ``n`` distinct rows, unit ``vectors`` as columns, and
    their variances, all in grid units."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    variances: np.ndarray
    total: float             # sum of all variances


def on_grid(df: DataFrame, vector: str, scale: int = SCALE) -> Column:
    """The vector on the grid as longs, null where the vector takes no part."""
    grid = F.transform(F.col(f"`{vector}`"), lambda c: F.floor(c.cast("double") * scale))
    fits = F.forall(F.col(f"`{vector}`"), lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                    & (F.abs(c.cast("double") * scale) <= LARGEST))
    return F.when((F.size(F.col(f"`{vector}`")) > 0) & fits, grid)


def matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    """The rows of a list column of one length as a matrix."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Distance from the mean; taken from whole numbers as far as they fit, so a constant column is exactly zero."""
    if max([abs(s) for s in sums] + [int(np.abs(x).max(initial=0)) * n]) < 1 << 61:
        return (x * np.int64(n) - np.array(sums, dtype=np.int64)) / n
    return ((x.astype(object) * n - np.array(sums, dtype=object)) / n).astype(np.float64)


def summed(rows: DataFrame, per_batch, size: int) -> np.ndarray:
    """Sum of a ``size`` x ``size`` matrix over all batches: each task adds up its own, Spark adds up the tasks'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                total += per_batch(batch)
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                         names=["i", "j", "value"])

    entries = rows.mapInArrow(run, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    out = np.zeros((size, size))
    for i, j, value in entries:
        out[i, j] = out[j, i] = value
    return out


def column_sums(rows: DataFrame, size: int) -> list[int]:
    """Exact sums of all columns, as whole numbers of any size: upper and lower bits are summed apart, first inside the tasks."""
    bits = 26

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch)
                high += (x >> bits).sum(axis=0)
                low += (x & ((1 << bits) - 1)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(high), pa.array(low)], names=["i", "high", "low"])

    parts = rows.mapInArrow(run, "i int, high long, low long")
    entries = parts.groupBy("i").agg(*[F.sum(F.col(c).cast("decimal(38,0)")) for c in ("high", "low")]).collect()
    out = [0] * size
    for i, high, low in entries:
        out[i] = (int(high) << bits) + int(low)
    return out


def solve(x: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Rows of ``q`` with ``q @ r = x`` for an upper triangular ``r``, column by column."""
    q = np.empty_like(x)
    for j in range(r.shape[0]):
        q[:, j] = (x[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def cholesky(products: np.ndarray, shift: float) -> np.ndarray:
    """Upper triangular factor of a Gram matrix, shifted as far as it takes to have one."""
    least = np.finfo(float).eps * max(np.trace(products), np.finfo(float).tiny)
    while True:
        try:
            return np.linalg.cholesky(products + shift * np.eye(len(products))).T
        except np.linalg.LinAlgError:
            shift = max(100 * shift, least)


def factor(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred rows (up to an orthogonal matrix on its left), by repeated Gram passes."""
    size = len(sums)
    factors: list[np.ndarray] = []
    whole, rest = np.eye(size), np.eye(size)
    for turn in range(PASSES):

        def gram(batch: pa.RecordBatch, factors=tuple(factors)) -> np.ndarray:
            q = centred(matrix(batch), n, sums)
            for r in factors:
                q = solve(q, r)
            return q.T @ q

        products = summed(rows, gram, size)
        if turn and np.abs(products - np.eye(size)).max() < ORTHONORMAL:
            # what little the columns are off goes into R
            values, vectors = np.linalg.eigh(products)
            rest = (vectors * np.sqrt(values)).T
            break
        shift = 0.0 if turn else 11 * size * (size + 1) * np.finfo(float).eps * np.linalg.norm(products, 2)
        factors.append(cholesky(products, shift))
        whole = factors[-1] @ whole
    return rest @ whole


def fit(rows: DataFrame) -> Whitening | None:
    """Components of ``rows``, a written frame of distinct vectors ``x`` of longs, all of one length."""
    n = rows.count()
    if n < 2:
        return None
    size = len(rows.first()["x"])
    sums = column_sums(rows, size)
    _, singular, components = np.linalg.svd(factor(rows, n, sums))
    kept = singular > singular[0] * max(n, size) * np.finfo(float).eps
    variances = singular ** 2 / n
    return Whitening(n, sums, components[kept].T, variances[kept], float(variances.sum()))


def project(model: Whitening, x: np.ndarray, limit: int | None = None) -> np.ndarray:
    """Whitened coordinates of grid rows, one column a component."""
    return centred(x, model.n, model.sums) @ (model.vectors[:, :limit] / np.sqrt(model.variances[:limit]))


def measured(model: Whitening, rows: DataFrame, limit: int) -> float:
    """Largest entry of the covariance of the whitened distinct rows minus the identity, by one more pass."""
    count = model.vectors[:, :limit].shape[1]
    if not count:
        return 0.0

    def products(batch: pa.RecordBatch) -> np.ndarray:
        w = project(model, matrix(batch), limit)
        both = np.hstack([w, np.ones((len(w), 1))])
        return both.T @ both

    total = summed(rows, products, count + 1) / model.n
    mean = total[count, :count]
    return float(np.abs(total[:count, :count] - np.outer(mean, mean) - np.eye(count)).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of ``(n * x - sums) ** 2`` over the columns; null beyond a long."""
    bound = max([abs(s) for s in sums]) + int(np.abs(x).max(initial=0)) * n
    if bound * bound * len(sums) < 1 << 62:
        return np.square(x * np.int64(n) - np.array(sums, dtype=np.int64)).sum(axis=1).tolist()
    exact = ((x.astype(object) * n - np.array(sums, dtype=object)) ** 2).sum(axis=1)
    return [v if v < 1 << 63 else None for v in exact]


def whiten(vectors: DataFrame, components: int = 4, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """One row for each vector and component, up to ``components``: ``vec_id, component, n, deviation, whitened,
    explained, identity_error``."""
    kind = vectors.schema[vec_id].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    grid = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), on_grid(vectors, vector, scale).alias("x")).where("x is not null")
    common = grid.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return vectors.sparkSession.createDataFrame([], schema)
    grid = grid.where(F.size("x") == common["d"])
    distinct = written(grid.select("x").distinct(), "distinct-vectors")
    model = fit(distinct)
    if model is None or not len(model.variances):
        return vectors.sparkSession.createDataFrame([], schema)
    error, count = measured(model, distinct, components), model.vectors[:, :components].shape[1]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = model.variances[:count] / model.total
        for batch in batches:
            if not batch.num_rows:
                continue
            x, rows = matrix(batch), batch.num_rows
            place = np.repeat(np.arange(rows), count)
            far = deviations(x, model.n, model.sums)
            columns = [np.tile(np.arange(1, count + 1), rows), np.full(rows * count, model.n), [far[i] for i in place],
                       project(model, x, count).ravel(), np.tile(share, rows), np.full(rows * count, error)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(place)), *[pa.array(c, type=t) for c, t in zip(columns, types)]],
                                             names=names)

    return grid.mapInArrow(run, schema)
