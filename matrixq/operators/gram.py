"""The product of a matrix with its own transpose."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixq.model import Matrix, value_type_of, within_shape
from matrixq.operators.cells import coalesce_cells, transpose
from matrixq.operators.product import pick_strategy, summed_product
from matrixq.plans.limits import fits_broadcast
from matrixq.plans.skew import Sides, deal_out, deal_out_lines, split_hot_keys_upper
from matrixq.plans.stats import ProductStats
from matrixq.session import tune_for, tune_shuffle


STRATEGIES = ("auto", "join", "broadcast", "rows", "block")


def gram(m: Matrix, of: str = "columns", strategy: str = "auto", *, block: int | None = None,
         split_hot: bool = True, keep_zeros: bool = True, work_floor: int | None = None) -> Matrix:
    """``Mt x M`` for ``of='columns'``, ``M x Mt`` for ``of='rows'``.

    The result is symmetric: only the half ``i <= j`` is computed and then mirrored, but for
    ``rows``, which multiplies as ``matmul`` does.
    ``auto``, ``join`` and ``broadcast`` run the counting job of ``matmul``; ``broadcast``
    falls back to ``join`` if the matrix is too large for it. Cancelled cells and ``work_floor``
    are as in ``matmul``.
    """
    if of not in ("columns", "rows"):
        raise ValueError(f"of must be 'columns' or 'rows', got {of!r}")
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    if of == "rows":
        m = transpose(m)
    m = within_shape(m)
    stats = None
    if strategy == "auto":
        strategy, stats = pick_strategy(transpose(m), m, block=block)
    if strategy == "block":
        from matrixq.operators.blocks import block_product

        seen = stats and stats.seen
        return block_product(transpose(m), m, block=block, symmetric=True, seen=seen,
                             keep_zeros=keep_zeros)
    if strategy == "rows":
        from matrixq.operators.rowwise import row_product

        c = row_product(transpose(m), m)
        return c if keep_zeros else c.with_cells(c.cells.where("v <> 0"))
    c = _cell_gram(m, strategy, split_hot, stats, work_floor)
    return c if keep_zeros else c.with_cells(c.cells.where("v <> 0"))


def _cell_gram(m: Matrix, strategy: str, split_hot: bool, stats: ProductStats | None,
               work_floor: int | None) -> Matrix:
    left, right = _left(coalesce_cells(m)), _right(coalesce_cells(m))
    if not m.unique:
        tune_for(m.spark, m.cells)
    raw = Sides(_left(m), _right(m), "x", "y", m.unique)
    if stats is None and (split_hot or strategy == "broadcast"):
        stats = raw.stats()
    product = summed_product(value_type_of(m)).alias("v")
    if strategy == "broadcast" and fits_broadcast(stats.nnz_a):
        left = deal_out_lines(left, "x", "k", stats.nnz_a, stats)
        pairs = left.join(F.broadcast(right), "k").where("x <= y")
        half = pairs.groupBy(F.col("x").alias("i"), F.col("y").alias("j")).agg(product)
        return Matrix(mirror(half), m.n_cols, m.n_cols, unique=True)
    keys = ["k"]
    if split_hot:
        left, right, keys = split_hot_keys_upper(left, right, "x", "y", raw.hot_keys(stats, work_floor))
    if stats is not None:
        tune_shuffle(m.spark, stats.products)
        left, right = deal_out(left, right, keys, stats)
    pairs = left.join(right, keys).where("part_l < part_r or x <= y" if len(keys) > 1 else "x <= y")
    half = pairs.groupBy(F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j")).agg(product)
    return Matrix(mirror(half), m.n_cols, m.n_cols, unique=True)


def _left(m: Matrix) -> DataFrame:
    return m.cells.select(F.col("i").alias("k"), F.col("j").alias("x"), F.col("v").alias("left_v"))


def _right(m: Matrix) -> DataFrame:
    return m.cells.select(F.col("i").alias("k"), F.col("j").alias("y"), F.col("v").alias("right_v"))


def mirror(half: DataFrame) -> DataFrame:
    """The whole of a symmetric matrix from its cells with ``i <= j``, without a shuffle."""
    above = F.struct("i", "j")
    below = F.struct(F.col("j").alias("i"), F.col("i").alias("j"))
    places = F.when(F.col("i") < F.col("j"), F.array(above, below)).otherwise(F.array(above))
    return half.select(F.explode(places).alias("at"), "v").select("at.i", "at.j", "v")
