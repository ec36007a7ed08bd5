"""Whitening of vectors by shifted CholeskyQR.

Each component ``c`` becomes the whole number ``floor(scale * c) + offset``. The centred rows form
a tall matrix ``X``, which stays where it is: each pass over it gives a Gram matrix as wide as a
vector, summed by Spark, and its Cholesky factor makes the rows more orthogonal in the next pass,
where every task solves its own rows by the factors so far. The first Gram matrix gets a shift on
its diagonal, as large as its rounding errors may be, so it has a factor however badly
conditioned the rows are; the second and third factor remove what the shift and the first pass's
rounding have left. The product of the factors is the ``R`` of ``X = Q R``, accurate where the
Gram matrix alone would lose half of the digits. Its singular values and right singular vectors
are those of ``X``, and give eigenvalues and components of the covariance.

Only matrices as wide as a vector come to the driver, whatever the number of rows.

Rows whose vector is null or holds a null or a number that is not finite take no part; repeated
rows each count, and rows without id are kept. Vectors shorter than the longest are filled up with
zeros. Components without variance beyond rounding cannot be scaled and are left out, so one row
alone, equal rows and empty tables give no rows at all. ``deviation`` is null where it passes 64
bits, and a component that passes 64 bits is an error.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixq.llm import blocks
from matrixq.llm.blocks import finite, matrix
from matrixq.llm.common import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(blocks)

#: Passes at the most; three are enough unless some direction has no variance.
PASSES = 4
#: A Gram matrix this close to the identity is made orthogonal to rounding by its own factor.
CLOSE = 1e-6
#: Singular values below this share of the greatest are rounding errors.
NOTHING = 1e-12
EPS = float(np.finfo(np.float64).eps)


def solved(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of the upper triangular ``r``, by substitution."""
    out = np.empty_like(rows)
    for k in range(len(r)):
        out[:, k] = (rows[:, k] - out[:, :k] @ r[:k, k]) / r[k, k]
    return out


def centred(batch: pa.RecordBatch, mean: np.ndarray) -> np.ndarray:
    vectors = pa.Table.from_batches([batch])
    return matrix(vectors, "vector", len(mean), "int64").astype(np.float64) - mean


def summed(rows: DataFrame, size: int, per_batch: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum over all batches of an array of ``size`` doubles, added up within each task first."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(size), False
        for batch in batches:
            if batch.num_rows:
                total, seen = total + per_batch(batch), True
        if seen:
            places = np.arange(size, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(total)], names=["at", "x"])

    parts = rows.mapInArrow(partial, "at int, x double")
    found = parts.groupBy("at").agg(F.sum("x").alias("x")).toArrow()
    out = np.zeros(size)
    out[found["at"].to_numpy()] = found["x"].to_numpy()
    return out


def gram(rows: DataFrame, mean: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Gram matrix of the centred rows, solved by each factor in turn. Runs one job."""
    width = len(mean)
    upper = np.triu_indices(width)

    def per_batch(batch: pa.RecordBatch) -> np.ndarray:
        x = centred(batch, mean)
        for r in factors:
            x = solved(x, r)
        return (x.T @ x)[upper]

    out = np.zeros((width, width))
    out[upper] = summed(rows, len(upper[0]), per_batch)
    return np.triu(out) + np.triu(out, 1).T


def triangular(rows: DataFrame, mean: np.ndarray, n: int) -> np.ndarray:
    """A square matrix with the singular values and right singular vectors of the centred rows."""
    width = len(mean)
    composed, factors = np.eye(width), []
    for _ in range(PASSES):
        g = gram(rows, mean, factors)
        if factors and np.abs(g - np.eye(width)).max() <= CLOSE:
            return np.linalg.cholesky(g).T @ composed
        # The rounding of a Gram matrix of n rows: the bound under which a factor must exist.
        shift = 11 * (n * width + width * (width + 1)) * EPS * np.linalg.norm(g, 2)
        r = None
        if factors:
            try:
                r = np.linalg.cholesky(g).T
            except np.linalg.LinAlgError:
                r = None  # some direction has no variance
        if r is None:
            if shift == 0:
                break
            r = np.linalg.cholesky(g + shift * np.eye(width)).T
        factors.append(r)
        composed = r @ composed
    # Not orthogonal, as a direction has no variance: what is left is put into the factor.
    values, vectors = np.linalg.eigh(gram(rows, mean, factors))
    return np.sqrt(np.maximum(values, 0))[:, None] * vectors.T @ composed


def deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum of ``(n * x - S) ** 2`` over each row, null beyond 64 bits."""
    reach = max((abs(s) for s in sums), default=0) + n * (int(np.abs(x).max()) if x.size else 0)
    if reach >= 1 << 62:
        apart = x.astype(object) * n - np.array(sums, object)
        exact = (apart * apart).sum(1)
        return pa.array([int(e) if e < 1 << 63 else None for e in exact], pa.int64())
    apart = np.abs(x * n - np.array(sums, np.int64))
    fits = (apart < 3_037_000_500).all(1)  # the root of the greatest 64-bit number
    squares = np.where(fits[:, None], apart, 0) ** 2
    high, low = (squares >> 32).sum(1), (squares & 0xFFFFFFFF).sum(1)
    high += low >> 32
    total = (high << 32) + (low & 0xFFFFFFFF)
    return pa.array(total, pa.int64(), mask=~fits | (high >= 1 << 31))


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = 8,
           scale: int = 1024, offset: int = 100_000) -> DataFrame:
    """Rows ``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for each
    vector and each of the first ``components`` components, numbered from 1 by falling variance.

    ``deviation``: exact squared distance from the mean, times ``n`` squared. ``whitened``: the
    centred vector along the component, over its standard deviation. ``explained``: the component's
    share of all variance. ``identity_error``: how far the covariance of all whitened rows is from
    the identity at most, measured by a pass of its own. Runs a job for each pass.
    """
    source = F.col(f"`{vector}`")
    whole = F.transform(
        source, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long") + offset
    )
    rows = written(
        df.where(finite(source)).select(
            F.col(f"`{vec_id}`").cast("long").alias("vec_id"), whole.alias("vector")
        ), "whole-vectors",
    )
    seen = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    n, width = seen["n"], seen["width"] or 0
    filled = rows.select("vec_id", F.concat(
        "vector", F.array_repeat(F.lit(offset).cast("long"), F.lit(width) - F.size("vector"))
    ).alias("vector"))
    schema = ("vec_id long, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    if not n or not width:
        return df.sparkSession.createDataFrame([], schema)
    sums = _sums(filled, width)
    mean = np.array([s / n for s in sums])
    _, singular, directions = np.linalg.svd(triangular(filled, mean, n))
    kept = np.flatnonzero(singular > NOTHING * singular[0])[:components] if singular[0] > 0 else []
    if not len(kept):
        return df.sparkSession.createDataFrame([], schema)
    variance = singular**2 / n
    explained = variance[kept] / variance.sum()
    project = directions[kept].T / np.sqrt(variance[kept])
    k = len(kept)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        w = centred(batch, mean) @ project
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])

    found = summed(filled, k + k * k, moments) / n
    covariance = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
    error = float(np.abs(covariance - np.eye(k)).max())

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(pa.Table.from_batches([batch]), "vector", width, "int64")
            w = (x.astype(np.float64) - mean) @ project
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(each), n)),
                deviations(x, n, sums).take(pa.array(each)), pa.array(w.ravel()),
                pa.array(np.tile(explained, len(x))), pa.array(np.full(len(each), error)),
            ], names=[field.split()[0] for field in schema.split(", ")])

    return filled.mapInArrow(give, schema)


def _sums(rows: DataFrame, width: int) -> list[int]:
    """Exact sum of each place of the vectors, in whole numbers of any size."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, object)
        for batch in batches:
            x = matrix(pa.Table.from_batches([batch]), "vector", width, "int64")
            if x.size:
                safe = int(np.abs(x).max()) * len(x) < 1 << 62
                total = total + (x.sum(0) if safe else x.astype(object).sum(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()),
             pa.array([int(t) for t in total], pa.decimal128(38, 0))], names=["at", "x"]
        )

    parts = rows.mapInArrow(partial, "at int, x decimal(38,0)").groupBy("at")
    found = parts.agg(F.sum("x").cast("decimal(38,0)").alias("x")).collect()
    return [int(r["x"]) for r in sorted(found, key=lambda r: r["at"])]
