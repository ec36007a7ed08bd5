"""The product ``C = A x B`` and its special shapes."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matrixq.model import Matrix, value_type_of, within_shape
from matrixq.operators import prefilter
from matrixq.operators.cells import coalesce_cells
from matrixq.plans.choose import choose_strategy, default_block
from matrixq.plans.limits import (
    BROADCAST_LIMIT_BYTES,
    CELLS_PER_TASK,
    MAX_PARTITIONS,
    PRODUCTS_PER_TASK,
    fits_broadcast,
)
from matrixq.plans.skew import LINE_SLACK, Sides, deal_out, deal_out_lines, split_hot_keys
from matrixq.plans.stats import ProductStats, row_products, row_work
from matrixq.session import tune_for, tune_shuffle

STRATEGIES = ("auto", "join", "broadcast", "copartition", "rows", "block")
MIN_COPARTITIONS = 64
# Half of a 32-bit index.
HALF = 1 << 16
# A side of which a smaller share has a partner is filtered before the join.
MOSTLY_MET = 0.7


def check_conformable(a: Matrix, b: Matrix) -> None:
    """Declared inner sizes must agree. Runs no job; unknown sizes are not checked.

    A size that was inferred from the cells is a lower bound only, so it is warned about.
    """
    if a.n_cols is None or b.n_rows is None or a.n_cols == b.n_rows:
        return
    sizes = f"{a.shape} by {b.shape}: inner sizes differ"
    fits = (a.inferred_cols or a.n_cols > b.n_rows) and (b.inferred_rows or b.n_rows > a.n_cols)
    if not fits:
        raise ValueError(f"cannot multiply {sizes}")
    warnings.warn(f"multiplying {sizes}, one of them was inferred from the cells", stacklevel=3)


def matmul(a: Matrix, b: Matrix, strategy: str = "auto", *, block: int | None = None,
           num_partitions: int | None = None, split_hot: bool = True,
           broadcast_limit: int = BROADCAST_LIMIT_BYTES, keep_zeros: bool = True,
           work_floor: int | None = None) -> Matrix:
    """``A x B``; duplicate cells of the inputs add up.

    The result is the same whatever the plan: a cell that some product went into stays if the sum
    is zero, or is dropped with ``keep_zeros=False``. A cell outside of a declared shape fails the
    job. ``work_floor``: products of one inner index from which it may be split.

    ``join``: both sides shuffled on the inner index, then, where products are many, each left cell
    with its row of ``B`` to the task of its output row. A job counts the cells per inner index
    first, and hot indexes are split; ``split_hot=False`` leaves that out.
    ``broadcast``: the side that fits ``broadcast_limit`` bytes is broadcast; if neither
    does, the product falls back to ``join``. Counts a side whose size is not declared.
    ``copartition``: both sides hash partitioned alike on the inner index, so the join adds no
    shuffle; see ``copartition`` to keep that layout for several products.
    ``rows``: rows of ``A`` dealt into parts, each with the rows of ``B`` that it names; no partial
    sum is shuffled. A job counts the products of each row first.
    ``block``: tiles of ``block x block`` multiplied by a dense kernel, or cell by cell where they
    are nearly empty.
    ``auto``: by size where a side is known to be small, else by one counting job.
    """
    check_conformable(a, b)
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    a, b = within_shape(a), within_shape(b)
    stats = None
    if strategy == "auto":
        strategy, stats = pick_strategy(a, b, block=block, broadcast_limit=broadcast_limit)
    if strategy == "block":
        from matrixq.operators.blocks import block_product

        return block_product(a, b, block=block, seen=stats and stats.seen, keep_zeros=keep_zeros)
    if strategy == "rows":
        from matrixq.operators.rowwise import row_product

        c = row_product(a, b)
        return c if keep_zeros else c.with_cells(c.cells.where("v <> 0"))
    c = _cell_product(a, b, strategy, num_partitions, split_hot, broadcast_limit, stats, work_floor)
    return c if keep_zeros else c.with_cells(c.cells.where("v <> 0"))


def _cell_product(a: Matrix, b: Matrix, strategy: str, num_partitions: int | None, split_hot: bool,
                  broadcast_limit: int, stats: ProductStats | None,
                  work_floor: int | None) -> Matrix:
    if strategy == "copartition":
        prepared = copartition(a, b, num_partitions, split_hot=split_hot, work_floor=work_floor)
        return multiply_prepared(prepared)
    if strategy == "broadcast":
        small = broadcast_side(a, b, broadcast_limit, stats)
        if small is not None:
            return _broadcast_product(a, b, small, stats)
    left, right, keys, stats = _sides(a, b, split_hot, stats, work_floor)
    if stats is not None and stats.tasks() is not None:
        if _longest_row(a, b) <= LINE_SLACK * PRODUCTS_PER_TASK:
            return _sums_by_row(left, right, keys, stats, a, b)
        tune_shuffle(a.spark, stats.products)
        left, right = deal_out(left, right, keys, stats)
    return _sum_products(left.join(right, keys), a, b)


def _longest_row(a: Matrix, b: Matrix) -> int:
    """Products of the output row that has most. Duplicates are summed only where they might be what
    makes it too long."""
    count = lambda x, y: row_products(x, y).agg(F.max("products")).first()[0] or 0
    longest = count(a, b)
    if longest <= LINE_SLACK * PRODUCTS_PER_TASK or (a.unique and b.unique):
        return longest
    return count(coalesce_cells(a), coalesce_cells(b))


def _sums_by_row(left: DataFrame, right: DataFrame, keys: list[str], stats: ProductStats, a: Matrix,
                 b: Matrix) -> Matrix:
    """Products that are formed where their sums are: each left cell is joined with its row of
    ``B`` in an array and sent to the task of its output row, so no product is shuffled.

    Indexes that fit 32 bits go in two halves of 16, the upper ones in runs, and whole values in 8 or 16
    where a row's fit. No output row may have more products than a task should form by far.
    """
    tasks = stats.tasks()
    value_type = value_type_of(a, b)
    packed = right.repartition(tasks, *keys).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("j", F.col("right_v").cast(value_type).alias("v")))).alias("row")
    )
    halves = {"js": F.col("row.j")}
    if stats.seen[2] < 1 << 31:
        halves = {
            "js": F.transform("row.j", lambda j: (j.bitwiseAND(HALF - 1) - HALF // 2).cast("smallint")),
            "upper": F.transform("row.j", lambda j: F.shiftright(j, 16).cast("smallint")),
        }
    values, rest, held = F.col("row.v"), F.lit(True), []
    for kind, most in (("tinyint", 1 << 7), ("smallint", 1 << 15)) if value_type == "bigint" else ():
        fits = F.forall("row", lambda cell: cell["v"].between(-most, most - 1))  # noqa: B023
        fits = F.coalesce(fits, F.lit(False))
        held.append(F.when(rest & fits, values).cast(f"array<{kind}>").alias(kind))
        rest = rest & ~fits
    held.append(F.when(rest, values).alias("large"))
    packed = packed.select(*keys, *(c.alias(name) for name, c in halves.items()), *held)
    columns = [c for c in packed.columns if c not in keys]
    sent = left.repartition(tasks, *keys).join(packed, keys).select("i", "left_v", *columns).repartition(tasks, "i")
    kinds = [c for c in columns if c not in halves]
    whole_row = F.coalesce(*(F.col(c).cast(f"array<{value_type}>") for c in kinds))
    cells = F.arrays_zip(*(F.col(c) for c in halves), whole_row.alias("right_v"))
    pairs = sent.select("i", "left_v", F.inline(cells))
    j = F.col("js").cast("bigint")
    if "upper" in halves:
        j = F.col("upper").cast("bigint") * HALF + j + HALF // 2
    return _sum_products(pairs.select("i", "left_v", "right_v", j.alias("j")), a, b)


def pick_strategy(a: Matrix, b: Matrix, *, block: int | None = None,
                  broadcast_limit: int = BROADCAST_LIMIT_BYTES):
    """The strategy ``auto`` takes, and the statistics it was taken from, if any.

    A declared vector needs none: it has one product per cell of the other side. Otherwise
    one counting job runs; it also finds a shape that is not declared. A second one estimates the
    cells of the result where the choice hangs on them.
    """
    for vector, extent in ((b, b.n_cols), (a, a.n_rows)):
        bound = vector.max_cells()
        if extent == 1 and bound is not None and fits_broadcast(bound, broadcast_limit):
            return "broadcast", None
    tune_for(a.spark, *(m.cells for m in (a, b) if not m.unique))
    stats = raw_sides(a, b).stats()
    rows, inner, cols = stats.seen
    rows, cols = (s if n is None else n for s, n in ((rows, a.n_rows), (cols, b.n_cols)))
    cores = a.spark.sparkContext.defaultParallelism
    block = block or default_block(rows, cols, cores)
    return choose_strategy(
        stats, rows, inner, cols, block, broadcast_limit, cores,
        lambda: row_work(coalesce_cells(a), coalesce_cells(b)).sums,
    ), stats


def broadcast_side(a: Matrix, b: Matrix, limit: int = BROADCAST_LIMIT_BYTES,
                   stats: ProductStats | None = None) -> str | None:
    """Which side may be broadcast: ``'right'``, ``'left'`` or none.

    Declared bounds decide first. Where they do not, the cells are counted, duplicates and all,
    right side first.
    """
    sides = (("right", b), ("left", a))
    for name, side in sides:
        bound = side.max_cells()
        if bound is not None and fits_broadcast(bound, limit):
            return name
    for name, side in sides:
        if stats is not None:
            count = stats.nnz_b if name == "right" else stats.nnz_a
        else:
            count = side.cells.count()
        if fits_broadcast(count, limit):
            return name
    return None


def _left(cells: DataFrame) -> DataFrame:
    return cells.select(F.col("j").alias("k"), "i", F.col("v").alias("left_v"))


def _right(cells: DataFrame) -> DataFrame:
    return cells.select(F.col("i").alias("k"), "j", F.col("v").alias("right_v"))


def summed_product(value_type: str) -> Column:
    """The factors are widened first, so that small whole types cannot overflow."""
    left, right = F.col("left_v").cast(value_type), F.col("right_v").cast(value_type)
    return F.sum(left * right).cast(value_type)


def _sum_products(pairs: DataFrame, a: Matrix, b: Matrix) -> Matrix:
    """Partial sums form in each task before the output cells are shuffled."""
    cells = pairs.groupBy("i", "j").agg(summed_product(value_type_of(a, b)).alias("v"))
    return Matrix(cells, a.n_rows, b.n_cols, unique=True)


def _sides(a: Matrix, b: Matrix, split_hot: bool, stats: ProductStats | None,
           work_floor: int | None = None):
    """Both factors keyed by the inner index, the columns to join them on, and the statistics,
    which are counted if hot indexes are to be split."""
    tune_for(a.spark, *(m.cells for m in (a, b) if not m.unique))
    left = _left(coalesce_cells(a).cells)
    right = _right(coalesce_cells(b).cells)
    if not split_hot:
        return left, right, ["k"], stats
    raw = raw_sides(a, b)
    stats = stats or raw.stats()
    if not raw.unique and stats.tasks() is not None:
        # Duplicates make for products that are none, and for fewer hot indexes.
        raw = Sides(left, right, "i", "j", True)
        stats = raw.stats()
    left, right = _only_met(left, right, stats)
    return *split_hot_keys(left, right, "i", "j", raw.hot_keys(stats, work_floor)), stats


def _only_met(left: DataFrame, right: DataFrame, stats: ProductStats) -> tuple[DataFrame, DataFrame]:
    """Leaves out cells without a partner before they are shuffled, where many have none: bitmaps
    of the other side's inner indexes tell them."""
    if not prefilter.fits(stats.seen[1]) or stats.met_a is None:
        return left, right
    kept_left, kept_right = left, right
    if stats.met_a < MOSTLY_MET * stats.nnz_a:
        kept_left = prefilter.with_partner(left, "k", prefilter.bitmaps(right, "k"))
    if stats.met_b < MOSTLY_MET * stats.nnz_b:
        kept_right = prefilter.with_partner(right, "k", prefilter.bitmaps(left, "k"))
    return kept_left, kept_right


def raw_sides(a: Matrix, b: Matrix) -> Sides:
    return Sides(_left(a.cells), _right(b.cells), "i", "j", a.unique and b.unique)


def _broadcast_product(a: Matrix, b: Matrix, small: str, stats: ProductStats | None) -> Matrix:
    """Only the broadcast side is made unique, as its bound counts distinct cells; the other
    side streams past without a shuffle, duplicates and all.

    Where statistics say that cells are multiplied many times, that side is dealt out first:
    a file split holds few cells then for the work they bring. It goes by output row (by
    column if ``B`` streams), so that all products of an output cell meet in one task and the
    sums need no shuffle.
    """
    streamed, line = (a, "i") if small == "right" else (b, "j")
    if stats is not None and stats.tasks() is not None:
        streamed = coalesce_cells(streamed)
        nnz = stats.nnz_a if small == "right" else stats.nnz_b
        dealt = deal_out_lines(streamed.cells, line, "j" if line == "i" else "i", nnz, stats)
        streamed = streamed.with_cells(dealt)
    if small == "right":
        left, right = _left(streamed.cells), F.broadcast(_right(coalesce_cells(b).cells))
    else:
        left, right = F.broadcast(_left(coalesce_cells(a).cells)), _right(streamed.cells)
    return _sum_products(left.join(right, "k"), a, b)


@dataclass(frozen=True)
class Prepared:
    """Two factors laid out for a join without a further shuffle."""

    left: DataFrame
    right: DataFrame
    keys: list[str]
    num_partitions: int
    a: Matrix
    b: Matrix

    def persist(self) -> Prepared:
        """Persist both factors and fill the cache: only a filled one shows the planner how it
        is partitioned. Runs a job for each factor."""
        self.left.persist().count()
        self.right.persist().count()
        return self

    def unpersist(self) -> None:
        self.left.unpersist()
        self.right.unpersist()


def copartition(a: Matrix, b: Matrix, num_partitions: int | None = None, *,
                split_hot: bool = True, work_floor: int | None = None) -> Prepared:
    """Both factors hash partitioned alike on the inner index, hot indexes split.

    Without ``num_partitions`` there are as many as cells and products call for, at least 64.
    Persist the result to use one layout for several products.
    """
    check_conformable(a, b)
    left, right, keys, stats = _sides(within_shape(a), within_shape(b), split_hot, None, work_floor)
    if num_partitions is None:
        by_cells = -(-(stats.nnz_a + stats.nnz_b) // CELLS_PER_TASK) if stats else 0
        by_products = (stats.tasks() or 0) if stats else 0
        num_partitions = min(MAX_PARTITIONS, max(MIN_COPARTITIONS, by_cells, by_products))
    return Prepared(
        left.repartition(num_partitions, *keys),
        right.repartition(num_partitions, *keys),
        keys, num_partitions, a, b,
    )


def multiply_prepared(p: Prepared) -> Matrix:
    return _sum_products(p.left.join(p.right, p.keys), p.a, p.b)


def matvec(a: Matrix, x: Matrix, *, broadcast_limit: int = BROADCAST_LIMIT_BYTES) -> Matrix:
    """``A`` times a column vector, an ``n x 1`` matrix."""
    if x.n_cols != 1:
        raise ValueError(f"matvec needs a column vector, got shape {x.shape}")
    return matmul(a, x, "broadcast", broadcast_limit=broadcast_limit)


def vecmat(x: Matrix, a: Matrix, *, broadcast_limit: int = BROADCAST_LIMIT_BYTES) -> Matrix:
    """A row vector, a ``1 x m`` matrix, times ``A``."""
    if x.n_rows != 1:
        raise ValueError(f"vecmat needs a row vector, got shape {x.shape}")
    return matmul(x, a, "broadcast", broadcast_limit=broadcast_limit)


def sum_of_product(a: Matrix, b: Matrix) -> DataFrame:
    """One row ``(total)``: the sum of all cells of ``A x B``, without forming the product.

    Summing over rows and columns first leaves, for each inner index, the sum of that column
    of ``A`` times the sum of that row of ``B``: work in the number of cells, not of products.
    """
    check_conformable(a, b)
    left = a.cells.groupBy(F.col("j").alias("k")).agg(F.sum("v").alias("left_v"))
    right = b.cells.groupBy(F.col("i").alias("k")).agg(F.sum("v").alias("right_v"))
    value_type = value_type_of(a, b)
    value = F.coalesce(summed_product(value_type), F.lit(0).cast(value_type))
    return left.join(right, "k").agg(value.alias("total"))
