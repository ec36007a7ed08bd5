"""Aggregates over the cells of a matrix."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixq.model import Matrix
from matrixq.operators.cells import coalesce_cells

COLUMN_CHUNK = 16_384


def info(m: Matrix) -> DataFrame:
    """One row ``(n_rows, n_cols, nnz, density)``; a shape that is not declared is inferred
    as greatest index plus one. Duplicates of a cell count once."""
    cells = coalesce_cells(m).cells
    rows = F.lit(m.n_rows) if m.n_rows is not None else F.coalesce(F.max("i") + 1, F.lit(0))
    cols = F.lit(m.n_cols) if m.n_cols is not None else F.coalesce(F.max("j") + 1, F.lit(0))
    shape = cells.agg(
        rows.cast("bigint").alias("n_rows"),
        cols.cast("bigint").alias("n_cols"),
        F.count("*").alias("nnz"),
    )
    area = F.col("n_rows").cast("double") * F.col("n_cols")
    return shape.withColumn("density", F.try_divide(F.col("nnz").cast("double"), area))


def infer_dims(m: Matrix) -> Matrix:
    """Declare the shape that the cells show. Runs one job, and none where it is declared."""
    if m.n_rows is not None and m.n_cols is not None:
        return m
    row = m.cells.agg(F.max("i").alias("i"), F.max("j").alias("j")).first()
    seen = [0 if top is None else top + 1 for top in (row["i"], row["j"])]
    return replace(
        m,
        n_rows=seen[0] if m.n_rows is None else m.n_rows,
        n_cols=seen[1] if m.n_cols is None else m.n_cols,
        inferred_rows=m.inferred_rows or m.n_rows is None,
        inferred_cols=m.inferred_cols or m.n_cols is None,
    )


def index_range(m: Matrix) -> DataFrame:
    """One row ``(min_i, max_i, min_j, max_j)``, nulls for a matrix without cells."""
    return m.cells.agg(*[
        f(axis).alias(f"{name}_{axis}")
        for axis in ("i", "j") for name, f in (("min", F.min), ("max", F.max))
    ])


def nnz(m: Matrix) -> DataFrame:
    """One row ``(nnz)``: the number of distinct cells."""
    return coalesce_cells(m).cells.agg(F.count("*").alias("nnz"))


def is_empty(m: Matrix) -> bool:
    return m.cells.isEmpty()


def total(m: Matrix) -> DataFrame:
    """One row ``(total)``: the sum of all values."""
    return m.cells.agg(F.sum("v").alias("total"))


def row_sums(m: Matrix) -> Matrix:
    """An ``n_rows x 1`` matrix."""
    sums = m.cells.groupBy("i").agg(F.sum("v").alias("v"))
    return Matrix(sums.select("i", F.lit(0).cast("bigint").alias("j"), "v"), m.n_rows, 1, True)


def column_sums(m: Matrix) -> Matrix:
    """A ``1 x n_cols`` matrix."""
    sums = m.cells.groupBy("j").agg(F.sum("v").alias("v"))
    return Matrix(sums.select(F.lit(0).cast("bigint").alias("i"), "j", "v"), 1, m.n_cols, True)


def distinct_indexes(m: Matrix, axis: str = "i") -> DataFrame:
    """The indexes of ``axis`` that have a cell."""
    return m.cells.select(axis).distinct()


def column_map(m: Matrix, chunk: int = COLUMN_CHUNK) -> DataFrame:
    """Rows ``(j, chunk, entries)``, ``entries`` mapping row index to value.

    A column is cut into ranges of ``chunk`` rows, so no map ever exceeds that many entries,
    however long the column is.
    """
    cells = coalesce_cells(m).cells
    keyed = cells.withColumn("chunk", F.expr(f"i div {int(chunk)}"))
    entries = F.map_from_entries(F.collect_list(F.struct("i", "v")))
    return keyed.groupBy("j", "chunk").agg(entries.alias("entries"))
