"""The one relation of this package: a matrix held as a DataFrame of cells.

A cell is a row ``(i, j, v)``; a cell that is absent counts as zero. The shape is declared
beside the cells, so that trailing empty rows and columns are never lost.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Matrix:
    """Cells plus what is known about them.

    ``n_rows`` / ``n_cols``: declared shape, ``None`` when unknown.
    ``unique``: no two rows share ``(i, j)``, so summing duplicates can be skipped.
    ``nnz``: an upper bound on the number of cells, where the caller knows one.
    ``inferred_rows`` / ``inferred_cols``: that size was read off the cells, so it may be too small.
    """

    cells: DataFrame
    n_rows: int | None = None
    n_cols: int | None = None
    unique: bool = False
    nnz: int | None = None
    inferred_rows: bool = False
    inferred_cols: bool = False

    @classmethod
    def of(cls, df: DataFrame, n_rows: int | None = None, n_cols: int | None = None, *,
           i: str = "i", j: str = "j", v: str = "v", unique: bool = False,
           nnz: int | None = None) -> Matrix:
        """A matrix over three columns of any DataFrame."""
        cells = df.select(
            F.col(i).cast("bigint").alias("i"),
            F.col(j).cast("bigint").alias("j"),
            F.col(v).alias("v"),
        )
        return cls(cells, n_rows, n_cols, unique, nnz)

    @property
    def spark(self) -> SparkSession:
        return self.cells.sparkSession

    @property
    def value_type(self) -> T.DataType:
        return self.cells.schema["v"].dataType

    @property
    def shape(self) -> tuple[int | None, int | None]:
        return self.n_rows, self.n_cols

    def with_cells(self, cells: DataFrame, **changes) -> Matrix:
        return replace(self, cells=cells, **changes)

    def max_cells(self) -> int | None:
        """Upper bound on the number of cells once duplicates are summed, without a job."""
        bounds = [] if self.nnz is None else [self.nnz]
        if self.n_rows is not None and self.n_cols is not None:
            bounds.append(self.n_rows * self.n_cols)
        return min(bounds, default=None)

    def persist(self) -> Matrix:
        return self.with_cells(self.cells.persist())

    def unpersist(self) -> Matrix:
        return self.with_cells(self.cells.unpersist())

    @property
    def T(self) -> Matrix:
        from matrixq.operators.cells import transpose

        return transpose(self)

    def __matmul__(self, other: Matrix) -> Matrix:
        from matrixq.operators.product import matmul

        return matmul(self, other)


def within_shape(m: Matrix) -> Matrix:
    """The same matrix; a cell outside of its declared shape fails the job that meets it.

    The check is a filter, which stays whatever columns are read.
    """
    bounds = [f"{c} >= 0 and {c} < {n}" for c, n in (("i", m.n_rows), ("j", m.n_cols)) if n is not None]
    if not bounds:
        return m
    where = F.concat_ws(" ", F.lit(f"outside of the shape {m.shape}: cell"), F.col("i"), F.col("j"))
    inside = F.when(F.expr(" and ".join(bounds)), F.lit(True)).otherwise(F.raise_error(where))
    return m.with_cells(m.cells.where(inside.cast("boolean")))


def value_type_of(*matrices: Matrix) -> str:
    """``bigint`` when every operand holds whole numbers, else ``double``."""
    whole = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
    return "bigint" if all(isinstance(m.value_type, whole) for m in matrices) else "double"
