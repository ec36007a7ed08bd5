"""Operators that work cell by cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixq.model import Matrix
from matrixq.plans.limits import fits_broadcast
from matrixq.plans.skew import Sides, split_hot_keys


def transpose(m: Matrix) -> Matrix:
    cells = m.cells.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")
    return m.with_cells(
        cells, n_rows=m.n_cols, n_cols=m.n_rows,
        inferred_rows=m.inferred_cols, inferred_cols=m.inferred_rows,
    )


def coalesce_cells(m: Matrix, on_duplicate: str = "sum", order_by: tuple[str, ...] = ()) -> Matrix:
    """One row per ``(i, j)``.

    ``sum``: duplicates add up, as they do in a product.
    ``last``: the duplicate that is greatest by ``order_by`` wins, columns of ``m.cells`` that
    must be given because rows of a DataFrame have no order of arrival.
    ``error``: a duplicate fails the job that meets it.

    All three are aggregates that combine before the shuffle, so one cell repeated in a large
    share of the rows costs no more than any other.
    """
    if m.unique:
        return m
    if on_duplicate == "sum":
        value = F.sum("v")
    elif on_duplicate == "last":
        if not order_by:
            raise ValueError("on_duplicate='last' needs order_by columns")
        # A single column can be kept in a hash aggregate, a struct needs a sort.
        order = F.struct(*order_by) if len(order_by) > 1 else F.col(order_by[0])
        value = F.max_by("v", order)
    elif on_duplicate == "error":
        clash = F.concat_ws(" ", F.lit("duplicate cell"), F.col("i"), F.col("j"))
        alone = F.when(F.col("n") == 1, F.lit(True)).otherwise(F.raise_error(clash))
        counted = m.cells.groupBy("i", "j").agg(F.first("v").alias("v"), F.count("*").alias("n"))
        # A filter is kept even where nobody reads the values.
        checked = counted.where(alone.cast("boolean")).select("i", "j", "v")
        return m.with_cells(checked, unique=True)
    else:
        raise ValueError(f"on_duplicate must be sum, last or error, got {on_duplicate!r}")
    cells = m.cells.groupBy("i", "j").agg(value.alias("v"))
    return m.with_cells(cells, unique=True)


def drop_zeros(m: Matrix) -> Matrix:
    return m.with_cells(coalesce_cells(m).cells.where("v <> 0"), unique=True)


def keep_matching_columns(a: Matrix, b: Matrix) -> Matrix:
    """The cells of ``a`` whose column has at least one cell in the same row of ``b``."""
    rows = b.cells.select(F.col("i").alias("k")).distinct()
    cells = _join_per_column(a, rows, b.n_rows)
    return a.with_cells(cells.select("i", F.col("k").alias("j"), "v"))


def scale_columns(a: Matrix, b: Matrix) -> Matrix:
    """``A[i, j]`` times the sum of column ``j`` of ``B``. This is not the product ``A x B``.

    Columns of ``a`` without a cell in ``b`` vanish.
    """
    sums = b.cells.groupBy(F.col("j").alias("k")).agg(F.sum("v").alias("s"))
    cells = _join_per_column(a, sums, b.n_cols)
    scaled = (F.col("v") * F.col("s")).alias("v")
    return a.with_cells(cells.select("i", F.col("k").alias("j"), scaled))


def _join_per_column(a: Matrix, per_column: DataFrame, extent: int | None) -> DataFrame:
    """The cells of ``a`` joined with one row per column ``k``.

    That side is broadcast when the declared ``extent`` bounds it; otherwise the join is
    shuffled, a job counts the cells per column, and columns that hold too many are split.
    """
    left = a.cells.select(F.col("j").alias("k"), "i", "v")
    if extent is not None and fits_broadcast(extent):
        return left.join(F.broadcast(per_column), "k")
    # The cells are joined one by one, so duplicates count here.
    sides = Sides(left, per_column, "i", "k", unique=True)
    hot = sides.hot_keys(sides.stats())
    left, right, keys = split_hot_keys(left, per_column, "i", "k", hot)
    return left.join(right, keys)
