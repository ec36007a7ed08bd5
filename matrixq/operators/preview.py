"""Small looks at a matrix, in a fixed order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matrixq.model import Matrix
from matrixq.operators.cells import coalesce_cells


def sample(m: Matrix, n: int = 5) -> DataFrame:
    """The first ``n`` cells by ``(i, j)``; a top-n, not a sort of everything."""
    return coalesce_cells(m).cells.orderBy("i", "j").limit(n)


def preview(m: Matrix, rows: int = 5, cols: int = 5) -> DataFrame:
    """The corner of the first ``rows`` x ``cols`` indexes in use, as cells, zeros filled in.

    One job finds those indexes; the cells are then read with a filter that reaches the scan.
    """
    first_rows, first_cols = least_indexes(m, rows, cols)
    zero = F.lit(0).cast(m.value_type).alias("v")
    corner = m.spark.createDataFrame(
        [(i, j) for i in first_rows for j in first_cols], "i bigint, j bigint"
    ).select("i", "j", zero)
    inside = m.cells.where(F.col("i").isin(first_rows) & F.col("j").isin(first_cols))
    return inside.select("i", "j", "v").unionByName(corner).groupBy("i", "j").agg(
        F.sum("v").alias("v")
    )


def least_indexes(m: Matrix, rows: int, cols: int) -> tuple[list[int], list[int]]:
    """The least row and column indexes in use, ``rows`` and ``cols`` at the most. One pass: each
    task keeps its least distinct ones of both, and only those are shuffled."""
    wanted = {"i": rows, "j": cols}

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {axis: np.zeros(0, np.int64) for axis in wanted}
        for batch in batches:
            for axis, n in wanted.items():
                values = batch.column(axis).drop_null().to_numpy()
                kept[axis] = np.unique(np.concatenate([kept[axis], values]))[:n]
        for axis, values in kept.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([axis] * len(values), pa.string()), pa.array(values)], names=["axis", "x"]
            )

    found = m.cells.select("i", "j").mapInArrow(least, "axis string, x bigint").distinct()
    order = Window.partitionBy("axis").orderBy("x")
    bound = F.when(F.col("axis") == "i", F.lit(rows)).otherwise(F.lit(cols))
    picked = found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= bound).collect()
    return tuple(sorted(r["x"] for r in picked if r["axis"] == axis) for axis in ("i", "j"))


def preview_table(m: Matrix, rows: int = 5, cols: int = 5) -> DataFrame:
    """The preview as lines ``(i, line)``, values with four decimals in column order."""
    entry = F.struct("j", F.format_string("%.4f", F.col("v").cast("double")).alias("x"))
    placed = F.array_sort(F.collect_list(entry))
    lines = preview(m, rows, cols).groupBy("i").agg(
        F.concat_ws(" ", F.transform(placed, lambda e: e["x"])).alias("line")
    )
    return lines.orderBy("i")
