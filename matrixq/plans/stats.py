"""What a product costs, from counts per inner index alone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matrixq.model import Matrix
from matrixq.plans.limits import EXPANDING_FROM, MAX_PARTITIONS, PRODUCTS_PER_TASK, fits_broadcast


@dataclass(frozen=True)
class ProductStats:
    """``products``: multiplications. ``work``: those plus the cells to move, over all inner
    indexes; ``top_work``: of the one with most. ``seen``: rows of ``A``, inner size and columns
    of ``B`` as the cells show them. ``met_a``, ``met_b``: cells whose inner index both factors
    have."""

    nnz_a: int
    nnz_b: int
    products: int
    work: float
    top_work: float
    seen: tuple[int, int, int] = (0, 0, 0)
    met_a: int | None = None
    met_b: int | None = None

    def tasks(self) -> int | None:
        """How many tasks should form the products, or None to leave it to adaptive execution.

        That sizes tasks by the bytes they read, which says little where each cell that is
        read gives many products.
        """
        if self.products < EXPANDING_FROM * (self.nnz_a + self.nnz_b):
            return None
        tasks = min(MAX_PARTITIONS, -(-self.products // PRODUCTS_PER_TASK))
        return tasks if tasks > 1 else None


def key_work(left: DataFrame, right: DataFrame, left_index: str, right_index: str) -> DataFrame:
    """Rows ``(k, n_left, n_right, top_left, top_right, work)`` from two DataFrames with a
    column ``k`` and an index column each: how many rows, the greatest index, the work.

    No pair is formed, and counts are combined before the shuffle, so that a key with a large
    share of the rows costs one row per task.
    """
    per_key = lambda df, index, side: df.groupBy("k").agg(
        F.count("*").alias(f"n_{side}"), F.max(index).alias(f"top_{side}")
    )
    both = per_key(left, left_index, "left").join(per_key(right, right_index, "right"), "k", "full")
    none = F.lit(0).cast("bigint")
    counts = both.withColumns({n: F.coalesce(n, none) for n in ("n_left", "n_right")})
    # In doubles, as the product of two counts may leave the 64-bit range.
    return counts.withColumn("work", F.expr("n_left + n_right + double(n_left) * n_right"))


def product_counts(work: DataFrame) -> DataFrame:
    """One row ``(nnz_a, nnz_b, products)``, the last exact, and what ``ProductStats`` holds
    besides."""
    whole = lambda e: F.expr(f"coalesce(sum({e}), 0)").cast("decimal(38,0)")
    pairs = "cast(n_left as decimal(19,0)) * cast(n_right as decimal(19,0))"
    extent = lambda c: F.coalesce(F.max(c) + 1, F.lit(0))
    return work.agg(
        whole("n_left").alias("nnz_a"), whole("n_right").alias("nnz_b"),
        whole(pairs).alias("products"), F.sum("work").alias("work"),
        F.max("work").alias("top_work"), extent("top_left").alias("rows"),
        extent("k").alias("inner"), extent("top_right").alias("cols"),
        whole("if(n_right > 0, n_left, 0)").alias("met_a"),
        whole("if(n_left > 0, n_right, 0)").alias("met_b"),
    )


def collect_stats(work: DataFrame) -> ProductStats:
    """Runs one aggregation job that returns one row."""
    row = product_counts(work).first()
    return ProductStats(
        int(row["nnz_a"]), int(row["nnz_b"]), int(row["products"]), row["work"] or 0.0,
        row["top_work"] or 0.0, (row["rows"], row["inner"], row["cols"]),
        int(row["met_a"]), int(row["met_b"]),
    )


# Rows of A whose output cells are estimated, and the size of their sketches, in powers of two.
SKETCHED_ROWS, SKETCH_BITS = 512, 12


@dataclass(frozen=True)
class RowWork:
    """What the rows of a product bring: ``products`` in all and of the longest row, ``cells`` of
    ``A`` that meet any of ``B``, ``sums``: about how many cells the result has. ``rows``,
    ``inner``, ``cols``: greatest indexes plus one. ``longest``: cells of the longest row of ``B``
    that is met."""

    products: int
    top_products: int
    cells: int
    sums: float
    rows: int = 0
    inner: int = 0
    cols: int = 0
    longest: int = 0


@dataclass(frozen=True)
class HotRow:
    i: int
    products: int
    cells: int


def _per_row(a: DataFrame, b: DataFrame, sketched: Column | None) -> DataFrame:
    """Rows ``(i, products, cells, k, cols, longest)``. No product is formed: a row of ``A`` is
    joined with the number of cells of each row of ``B``. With ``sketched`` also ``sums``, the
    estimated output cells of the rows that it says."""
    right = b.select(F.col("i").alias("k"), "j").groupBy("k").agg(F.count("*").alias("n"), F.max("j").alias("cols"))
    met = a.select("i", F.col("j").alias("k")).join(right, "k")
    counts = met.groupBy("i").agg(
        F.sum("n").alias("products"), F.count("*").alias("cells"), F.max("k").alias("k"),
        F.max("cols").alias("cols"), F.max("n").alias("longest"),
    )
    if sketched is None:
        return counts
    return counts.join(F.broadcast(_sketched_sums(a.where(sketched), b)), "i", "left")


def _sketched_sums(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows ``(i, sums)``: about how many cells each row of the result has, for the few rows of ``A``
    given. Only rows of ``B`` that these name are sketched, as a sketch is larger than a count by far.
    Runs a job that counts them."""
    left = a.select("i", F.col("j").alias("k"))
    names = left.select("k").distinct()
    if fits_broadcast(names.count()):
        names = F.broadcast(names)
    right = b.select(F.col("i").alias("k"), "j").join(names, "k", "left_semi")
    sketches = right.groupBy("k").agg(F.theta_sketch_agg("j", SKETCH_BITS).alias("sketch"))
    union = F.theta_union_agg("sketch", SKETCH_BITS)
    return left.join(sketches, "k").groupBy("i").agg(F.theta_sketch_estimate(union).alias("sums"))


def row_work(a: Matrix, b: Matrix, n_rows: int | None = None) -> RowWork:
    """Counts the products of each row and estimates its output cells. Runs a job for
    the rows that are sketched and one that returns one row.

    The columns of each row of ``B`` are sketched by the least of their hashes, 4,096 at the most,
    which is off by some 2 percent; the sketches of all rows of ``B`` that a row of ``A`` names make
    up that of the output row. About ``SKETCHED_ROWS``
    rows are sketched, chosen by hash, and stand for all by their products. Rows that are not
    declared are counted, roughly, by a job of their own unless ``n_rows`` gives their number.
    """
    n_rows = a.n_rows or n_rows or a.cells.agg(F.approx_count_distinct("i")).first()[0]
    step = max(1, n_rows // SKETCHED_ROWS)
    sketched = F.pmod(F.xxhash64("i"), F.lit(step)) == 0
    each = _per_row(a.cells, b.cells, sketched)
    none = lambda c: F.coalesce(c, F.lit(0))
    row = each.agg(
        none(F.sum("products")), none(F.max("products")), none(F.sum("cells")),
        none(F.sum("sums")), none(F.sum(F.when(F.col("sums").isNotNull(), F.col("products")))),
        none(F.max("i") + 1), none(F.max("k") + 1), none(F.max("cols") + 1),
        none(F.max("longest")),
    ).first()
    products, top, cells, sums, of, rows, inner, cols, longest = row
    estimate = sums * products / of if of else products
    area = (a.n_rows or rows) * (b.n_cols or cols)
    return RowWork(products, top, cells, min(estimate, products, area), rows, inner, cols, longest)


def row_products(a: Matrix, b: Matrix) -> DataFrame:
    """Rows ``(i, products, cells)``: multiplications that each row of ``A x B`` takes and cells of
    ``A`` that meet any of ``B``. Both factors hold each cell once."""
    return _per_row(a.cells, b.cells, None).select("i", "products", "cells")


def hot_rows(a: DataFrame, b: DataFrame, limit: int) -> list[HotRow]:
    """The rows with more products than ``limit``. Runs one job."""
    found = _per_row(a, b, None).where(F.col("products") > limit)
    return [HotRow(r["i"], r["products"], r["cells"]) for r in found.collect()]
