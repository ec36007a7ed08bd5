"""The product by rows of the output: Gustavson's algorithm over parts of the rows.

The rows of ``A`` are dealt into parts, each the work of one task. A row of ``B`` goes to the parts
whose rows name its index, and the part multiplies and sums up there, so no partial sum is ever
shuffled: what moves is ``A`` once and each row of ``B`` once for each part that names it.

There are so many parts that products, left cells and sums of each stay within bounds; the number
of sums is not known beforehand, and neither the products nor the size of the result bound it well,
so it is estimated by sketches (``plans.stats.row_work``). A row with more products than a part
should form is split by the output columns: each of its parts gets its share of the cells of ``B``
that the row meets, each beside the row's own cell, so its sums are whole in one task as well.
"""

from __future__ import annotations

import math

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixq.functions import cell_products, row_kernel
from matrixq.functions.row_kernel import CELLS, KINDS, LEFT, PAIRS, pack, pack_rows, row_sums
from matrixq.model import Matrix, value_type_of
from matrixq.operators.cells import coalesce_cells
from matrixq.plans.limits import (
    MAX_PARTITIONS,
    PART_CELLS,
    PART_PRODUCTS,
    PRODUCTS_PER_TASK,
    fits_broadcast,
    number_of_parts,
)
from matrixq.plans.stats import RowWork, hot_rows, row_work
from matrixq.session import tune_for, tune_shuffle

cloudpickle.register_pickle_by_value(row_kernel)
cloudpickle.register_pickle_by_value(cell_products)

# Left cells of a part for each inner index, from which on it is taken to name them all.
NAMES_ALL = 3
# Cells of a row of the right factor in one record, and pairs of cells of hot rows for a task.
ROW_PIECE, PAIRS_PER_TASK = 1 << 16, 1 << 20


def row_product(a: Matrix, b: Matrix, *, work: RowWork | None = None,
                part_products: int = PART_PRODUCTS) -> Matrix:
    """``A x B`` by parts of the rows. Runs a counting job unless ``work`` is given, and one more
    if a row has more products than a part should form. Results of more than 2**62 possible
    cells go through ``matmul(..., "join")``."""
    value_type = value_type_of(a, b)
    tune_for(a.spark, *(m.cells for m in (a, b) if not m.unique))
    cells_a, cells_b = coalesce_cells(a).cells, coalesce_cells(b).cells
    if work is None:
        # Duplicates need no sum where rows are only counted.
        n_rows = a.n_rows or a.cells.agg(F.approx_count_distinct("i")).first()[0]
        work = row_work(a.with_cells(cells_a), b.with_cells(cells_b), n_rows)
    width = max(b.n_cols or 0, work.cols, 1)
    n_rows = max(a.n_rows or 0, work.rows, 1)
    if width * n_rows >= 1 << 62:
        from matrixq.operators.product import matmul

        return matmul(a, b, "join")
    tune_shuffle(a.spark, 4 * work.cells)
    whole = value_type == "bigint"
    cores = a.spark.sparkContext.defaultParallelism
    limit = max(part_products, work.products // MAX_PARTITIONS)
    hot = hot_rows(cells_a, cells_b, limit) if work.top_products > limit else []
    rest = 1 - sum(h.products for h in hot) / max(1, work.products)
    parts = number_of_parts(
        math.ceil(rest * work.products), rest * work.sums, work.cells - sum(h.cells for h in hot),
        cores, part_products,
    )
    left = cells_a.select(F.col("i").alias("x"), F.col("j").alias("k"), F.col("v").cast(value_type).alias("v"))
    right = cells_b.select(F.col("j").alias("x"), F.col("i").alias("k"), F.col("v").cast(value_type).alias("v"))
    buckets = -(-(work.cells // parts) // PART_CELLS) or 1
    bucket = F.pmod(F.xxhash64("k"), F.lit(buckets))
    tasks = parts
    split = None
    if hot:
        # Each hot row has parts of its own, one for each class of columns.
        rows, last = [], parts
        for h in hot:
            share = -(-h.products // limit)
            rows.append((h.i, last, share))
            last += share
        listed = F.broadcast(a.spark.createDataFrame(rows, "x bigint, first bigint, share bigint"))
        split = _pairs_of_hot_rows(left.join(listed, "x"), right, buckets)
        left = left.join(listed.select("x"), "x", "left_anti")
        tasks += min(last - parts, -(-sum(h.products for h in hot) // PAIRS_PER_TASK))
    part = F.pmod(F.xxhash64("x"), F.lit(parts)).alias("part")
    left = left.select(part, "x", "k", "v")
    wide = max(width, n_rows, work.inner) >= 1 << 31
    key = lambda kind: ((F.col("part") * buckets + bucket) * KINDS + kind).alias("key")
    keyed = "key bigint, x binary, v binary"
    sent = left.select(key(LEFT), "x", "k", "v").mapInArrow(pack(whole), keyed)
    if not hot and work.cells >= NAMES_ALL * parts * work.inner:
        packed = right.select(bucket.alias("key"), "x", "k", "v").mapInArrow(pack(whole), keyed)
        everywhere = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint")))
        sent_right = packed.withColumn("part", everywhere).select(
            ((F.col("part") * buckets + F.col("key")) * KINDS + CELLS).alias("key"), "x", "v"
        )
    else:
        # Names are distinct anyway, so duplicate cells need no sum for them.
        names = a.cells.select(F.col("i").alias("x"), F.col("j").alias("k"))
        if hot:
            names = names.join(listed.select("x"), "x", "left_anti")
        names = names.select(part, "k").distinct()
        if fits_broadcast(min(work.cells, parts * work.inner)):
            names = F.broadcast(names)
            rows = _rows_of(right, work.longest, wide, whole)
        else:
            # In tasks by the cells that are copied, many times those that are read.
            spread = min(MAX_PARTITIONS, -(-work.products // PRODUCTS_PER_TASK))
            names = names.repartition(spread, "k")
            rows = _rows_of(right, work.longest, wide, whole).repartition(spread, "k")
        sent_right = rows.join(names, "k").select(key(F.col("kind")), "x", "v")
    sent = sent.unionByName(sent_right)
    if split is not None:
        sent = sent.unionByName(split.mapInArrow(pack(whole, ("v", "w")), keyed))
    tasks = min(MAX_PARTITIONS, tasks)
    of = F.expr(f"key div {KINDS * buckets}") % tasks
    arranged = sent.repartitionById(tasks, of.cast("int")).sortWithinPartitions("key")
    cells = arranged.mapInArrow(
        row_sums(width, buckets, whole, wide), f"i bigint, j bigint, v {value_type}"
    )
    return Matrix(cells, a.n_rows, b.n_cols, unique=True)


def _rows_of(right: DataFrame, longest: int, wide: bool, whole: bool) -> DataFrame:
    """Rows ``(k, kind, x, v)``: the cells of each row of the right factor, packed once and copied as
    they are. Rows above ``ROW_PIECE`` cells come in pieces, each dealt out by itself."""
    right = right.where("k is not null")
    pieces = F.lit(0)
    if longest > ROW_PIECE:
        long = right.groupBy("k").count().where(F.col("count") > ROW_PIECE)
        right = right.join(F.broadcast(long), "k", "left")
        share = F.ceil(F.coalesce("count", F.lit(1)) / ROW_PIECE)
        pieces = F.pmod(F.xxhash64("x"), share)
    placed = right.withColumn("piece", pieces).repartition("k", "piece")
    return placed.sortWithinPartitions("k", "piece", "x").select("k", "x", "v").mapInArrow(
        pack_rows(whole, wide), "k bigint, kind bigint, x binary, v binary"
    )


def _pairs_of_hot_rows(left: DataFrame, right: DataFrame, buckets: int) -> DataFrame:
    """The cells that hot rows meet, with the cell of the row beside each, for the parts of their
    columns. A part is sent what it multiplies and nothing else, so the copies of a row's
    cells do not grow with the number of its parts."""
    met = left.select("first", "share", F.col("x").alias("i"), "k", "v").join(
        right.select("k", "x", F.col("v").alias("w")), "k"
    )
    part = F.col("first") + F.pmod(F.xxhash64("x"), F.col("share"))
    return met.select((part * buckets * KINDS + PAIRS).alias("key"), "x", F.col("i").alias("k"), "v", "w")
