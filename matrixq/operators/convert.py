"""Cells to and from dense blocks and dense rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matrixq.functions.arrays import fill_gaps
from matrixq.model import Matrix, value_type_of
from matrixq.operators.aggregates import infer_dims
from matrixq.operators.cells import coalesce_cells
from matrixq.plans.limits import DENSE_RECORD_LIMIT


# Values that are gathered at a time before a record is put together.
PIECE = 1024


def _dense_arrays(keyed: DataFrame, keys: list[str], length: Column, value_type: str) -> DataFrame:
    """Rows ``keys + (data)`` from rows ``keys + (p, v)`` with distinct ``(keys, p)``.

    A record is built from dense pieces, as an aggregate keeps many groups in memory and a
    gathered cell takes several times the space of a value. Both steps use one shuffle.
    """
    zero = F.lit(0).cast(value_type)
    piece_length = F.least(F.lit(PIECE).cast("bigint"), length - F.col("piece") * PIECE)
    pieces = (
        keyed.repartition(*keys)
        .withColumn("piece", F.expr(f"p div {PIECE}"))
        .groupBy(*keys, "piece")
        .agg(F.array_sort(F.collect_list(F.struct(
            (F.col("p") % PIECE).alias("p"), F.col("v").cast(value_type).alias("x")
        ))).alias("placed"))
        .select(*keys, "piece", fill_gaps(F.col("placed"), piece_length, zero).alias("part"))
    )
    gathered = F.collect_list(F.struct(F.col("piece").alias("p"), F.col("part").alias("x")))
    records = pieces.groupBy(*keys).agg(F.array_sort(gathered).alias("placed"))
    up_to_last = F.element_at("placed", -1)["p"] + 1
    joined = records.select(
        *keys,
        F.flatten(
            fill_gaps(F.col("placed"), up_to_last, F.array_repeat(zero, PIECE))
        ).alias("start"),
    )
    tail = F.array_repeat(zero, (length - F.size("start")).cast("int"))
    return joined.select(*keys, F.concat("start", tail).alias("data"))


def to_blocks(m: Matrix, block: int = 1024) -> DataFrame:
    """Rows ``(bi, bj, n_rows, n_cols, data)``, ``data`` row-major; absent blocks are zero.

    Blocks at the lower and right edge are smaller. A block gathers at most ``block**2``
    cells, because duplicates are summed before it is formed.
    """
    if block * block > DENSE_RECORD_LIMIT:
        raise ValueError(f"a block of {block} x {block} values does not fit one record")
    m = infer_dims(m)
    size = F.lit(block).cast("bigint")
    # An edge block is narrower, so the width enters the position of a cell.
    high = lambda extent, index: F.least(size, F.lit(extent) - index * size)
    keyed = (
        coalesce_cells(m)
        .cells.withColumns({"bi": F.expr(f"i div {block}"), "bj": F.expr(f"j div {block}")})
        .withColumns(
            {"n_rows": high(m.n_rows, F.col("bi")), "n_cols": high(m.n_cols, F.col("bj"))}
        )
        .withColumn("p", (F.col("i") % block) * F.col("n_cols") + F.col("j") % block)
    )
    keys = ["bi", "bj", "n_rows", "n_cols"]
    return _dense_arrays(keyed, keys, F.col("n_rows") * F.col("n_cols"), value_type_of(m))


def from_blocks(blocks: DataFrame, n_rows: int, n_cols: int, block: int = 1024) -> Matrix:
    """The cells of dense blocks, zeros dropped."""
    cells = blocks.select("bi", "bj", "n_cols", F.posexplode("data").alias("p", "v")).select(
        (F.col("bi") * block + F.expr("p div n_cols")).cast("bigint").alias("i"),
        (F.col("bj") * block + F.expr("p % n_cols")).cast("bigint").alias("j"),
        "v",
    )
    return Matrix(cells.where("v <> 0"), n_rows, n_cols, unique=True)


def to_dense_rows(m: Matrix, *, all_rows: bool = False) -> DataFrame:
    """Rows ``(i, vals)`` with ``n_cols`` values each.

    Rows without a cell are left out, or come as zeros with ``all_rows``.
    """
    m = infer_dims(m)
    if m.n_cols > DENSE_RECORD_LIMIT:
        raise ValueError(f"a dense row of {m.n_cols} values does not fit one record; use blocks")
    value_type = value_type_of(m)
    keyed = coalesce_cells(m).cells.withColumnRenamed("j", "p")
    width = F.lit(m.n_cols).cast("bigint")
    rows = _dense_arrays(keyed, ["i"], width, value_type).withColumnRenamed("data", "vals")
    if not all_rows:
        return rows
    zeros = F.array_repeat(F.lit(0).cast(value_type), m.n_cols)
    every = m.spark.range(m.n_rows).withColumnRenamed("id", "i")
    return every.join(rows, "i", "left").select("i", F.coalesce("vals", zeros).alias("vals"))


def from_dense_rows(rows: DataFrame, n_rows: int | None, n_cols: int | None, *,
                    i: str = "i", vals: str = "vals", keep_zeros: bool = True) -> Matrix:
    """The cells of rows ``(i, vals)`` with one row per ``i``."""
    cells = rows.select(F.col(i).cast("bigint").alias("i"), F.posexplode(vals).alias("j", "v"))
    cells = cells.withColumn("j", F.col("j").cast("bigint"))
    return Matrix(cells if keep_zeros else cells.where("v <> 0"), n_rows, n_cols, unique=True)
