"""Embedding whitening by shifted CholeskyQR.

Entries are read as long integers ``x = floor(1024 * c) + 100000``, so sums and deviations are
exact.  The centred rows ``A`` (``(n * x - S) / n``, one rounding each) are never gathered:

1. A distributed Gram pass gives ``A'A``; its Cholesky factor, shifted by a multiple of rounding
   error so that it exists however ill-conditioned ``A`` is, is ``R1``.
2. Every task divides its rows by the factors found so far (triangular solves) and the next Gram
   pass gives the factor of what is left, until the rows are orthonormal to rounding.
3. ``R = Rk ... R1`` and ``A = Q R``.  With the SVD ``R = U s V'`` the covariance has the
   components ``V`` and eigenvalues ``s^2 / n``, and the whitened rows are ``sqrt(n) * Q U``:
   ``A V / s * sqrt(n)`` without losing the small components to the large ones.

What meets on the driver is the upper triangle of one d x d matrix per pass, summed by Spark.

Edge cases: rows whose vector is null or holds a null, NaN or infinite entry are dropped; the
dimension is the most frequent length (ties: the longest) among the others, and rows of another
length are dropped too (an empty vector is a length of its own); repeated rows and null ids count
and are returned like any other; directions without variance (constant or dependent dimensions,
fewer rows than dimensions, a single row) give no component; an empty table gives no rows.  Entries
beyond 2^52 in size are read as 2^52; a deviation beyond 64 bits is null.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.session import ship_package

from .common import stage, table

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
MOST_ENTRY = float(1 << 52)
#: Rows handled at once inside a task.
BLOCK_ROWS = 4096
#: Gram passes end when no entry is farther from the identity, or after so many.
ORTHONORMAL, MOST_PASSES = 1e-13, 6
_EPS = np.finfo(np.float64).eps


def usable(column: str):
    """The vector is there and every entry is a finite number."""
    return F.col(column).isNotNull() & F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))


def integer_vectors(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """``id, x`` of the remaining rows, staged, and the dimension (0: there is none)."""
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).filter(usable("v"))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = common["d"] if common else 0
    long = F.transform("v", lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-MOST_ENTRY)), F.lit(MOST_ENTRY))).cast("long") + SHIFT)
    return stage(rows.filter(F.size("v") == d).select("id", long.alias("x")), "whitening"), d


def matrices(batches, d: int):
    """A task's rows as (ids, integer matrix) in blocks of bounded size."""
    for batch in batches:
        for begin in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(begin, BLOCK_ROWS)
            yield part.column(0), part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def solve_rows(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``rows`` divided by upper triangular factors, one after the other, column by column."""
    q = rows
    for r in factors:
        out = np.empty_like(q, order="F")
        for j in range(q.shape[1]):
            out[:, j] = (q[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        q = out
    return q


def column_sums(vectors: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """Row count and the exact sum of every dimension."""
    def run(batches):
        n, total = 0, np.zeros(d, np.int64)
        for _, x in matrices(batches, d):
            n += len(x)
            total += x.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(total), pa.array([n] * d, pa.int64())], names=["i", "s", "n"])
    rows = vectors.mapInArrow(run, "i int, s long, n long").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).orderBy("i").collect()
    return (rows[0]["n"], np.array([r["s"] for r in rows], np.int64)) if rows else (0, np.zeros(d, np.int64))


def gram(vectors: DataFrame, d: int, size: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``q'q`` over the rows ``q = of(x)`` with ``size`` columns each."""
    up = np.triu_indices(size)

    def run(batches):
        total = np.zeros((size, size))
        for _, x in matrices(batches, d):
            q = of(x)
            total += q.T @ q
        yield pa.RecordBatch.from_arrays([pa.array(up[0].astype(np.int32)), pa.array(up[1].astype(np.int32)), pa.array(total[up])], names=["i", "j", "g"])
    out = np.zeros((size, size))
    for r in vectors.mapInArrow(run, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["g"]
    return out


def shifted_cholesky(g: np.ndarray, always: bool) -> np.ndarray:
    """Upper triangular factor of ``g``, with a shift where it would not exist (or ``always``)."""
    d = len(g)
    shift = 11 * (d * BLOCK_ROWS + d * (d + 1)) * _EPS / 2 * max(np.trace(g), np.finfo(np.float64).tiny)
    for step in range(0 if not always else 1, 60):
        try:
            r = np.linalg.cholesky(g + (shift * 4.0 ** (step - 1) if step else 0.0) * np.eye(d)).T
        except np.linalg.LinAlgError:
            continue
        if step or r.diagonal().min() > np.sqrt(d * _EPS) * r.diagonal().max():
            return r
    raise np.linalg.LinAlgError("no factor of the Gram matrix")


class Whitener:
    """Row count, sums, factors and components of one fit; applied to rows inside tasks."""

    def __init__(self, n: int, sums: np.ndarray):
        self.n, self.sums, self.factors = n, sums, []
        self.turn = np.zeros((len(sums), 0))
        self.explained = np.zeros(0)
        self.components = np.zeros((0, len(sums)))

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact (as Python integers where 64 bits could overflow)."""
        if len(x) and self.n * int(np.abs(x).max()) >= 1 << 61:
            x = x.astype(object)
        return self.n * x - self.sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(np.float64) / self.n

    def orthogonal(self, x: np.ndarray) -> np.ndarray:
        return solve_rows(self.centred(x), self.factors)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.orthogonal(x) @ self.turn

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sum over dimensions of ``(n * x - S) ** 2`` per row (null beyond 64 bits)."""
        y = self.scaled(x)
        rough = (y.astype(np.float64) ** 2).sum(axis=1)
        if (rough < 4e18).all():
            return (y * y).sum(axis=1).tolist()
        exact = [sum(v * v for v in row) for row in y.tolist()]
        return [v if v < 1 << 63 else None for v in exact]

    def finish(self, most: int) -> None:
        """SVD of the composed factor."""
        r = np.eye(len(self.sums))
        for f in self.factors:
            r = f @ r
        u, s, vt = np.linalg.svd(r)
        variance = s * s / self.n
        rank = int((s > len(s) * 8 * _EPS * s[0]).sum()) if len(s) and s[0] > 0 else 0
        keep = min(most, rank)
        self.turn = u[:, :keep] * np.sqrt(self.n)
        self.components = vt[:keep]
        self.explained = variance[:keep] / variance.sum() if keep else np.zeros(0)


def fit(vectors: DataFrame, d: int, most: int = COMPONENTS) -> Whitener:
    """Components of the staged ``id, x`` rows."""
    n, sums = column_sums(vectors, d)
    model = Whitener(n, sums)
    if n < 2:
        return model
    for step in range(MOST_PASSES):
        g = gram(vectors, d, d, model.orthogonal)
        if not g.any() or (step and np.abs(g - np.eye(d)).max() < ORTHONORMAL):
            break
        model.factors = [*model.factors, shifted_cholesky(g, step == 0)]
    if model.factors:
        model.finish(most)
    return model


def identity_error(vectors: DataFrame, d: int, model: Whitener) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, centred first."""
    k = model.turn.shape[1]

    def run(batches):
        total = np.zeros(k)
        for _, x in matrices(batches, d):
            total += model.whitened(x).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(total)], names=["i", "s"])
    mean = np.zeros(k)
    for r in vectors.mapInArrow(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect():
        mean[r["i"]] = r["s"] / model.n
    covariance = gram(vectors, d, k, lambda x: model.whitened(x) - mean) / model.n
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per row and component."""
    ship_package(df.sparkSession)
    schema = f"vec_id {df.schema[key].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    vectors, d = integer_vectors(df, key, vector)
    model = fit(vectors, d, most) if d else None
    k = model.turn.shape[1] if model else 0
    if not k:
        return df.sparkSession.createDataFrame([], schema)
    error = identity_error(vectors, d, model)

    def run(batches):
        for ids, x in matrices(batches, d):
            rows = len(x)
            again = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays([
                ids.take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, model.n, np.int64)),
                pa.array(model.deviations(x), pa.int64()).take(again), pa.array(np.ascontiguousarray(model.whitened(x)).reshape(-1)),
                pa.array(np.tile(model.explained, rows)), pa.array(np.full(rows * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return vectors.mapInArrow(run, schema)


def query(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
