"""Matrices from rows at hand and from a rule."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from matrixq.model import Matrix


def from_entries(spark: SparkSession, entries: Iterable[tuple], n_rows: int | None = None,
                 n_cols: int | None = None, value_type: str = "bigint") -> Matrix:
    """A small matrix from Python tuples ``(i, j, v)``."""
    rows = [(int(i), int(j), v) for i, j, v in entries]
    cells = spark.createDataFrame(rows, f"i bigint, j bigint, v {value_type}")
    return Matrix(cells, n_rows, n_cols)


def empty(spark: SparkSession, n_rows: int, n_cols: int, value_type: str = "double") -> Matrix:
    """A matrix of the given shape without a cell."""
    cells = spark.createDataFrame([], f"i bigint, j bigint, v {value_type}")
    return Matrix(cells, n_rows, n_cols, unique=True, nnz=0)


def identity(spark: SparkSession, n: int) -> Matrix:
    cells = spark.range(n).select(
        F.col("id").alias("i"), F.col("id").alias("j"), F.lit(1).cast("bigint").alias("v")
    )
    return Matrix(cells, n, n, unique=True, nnz=n)


def generate(spark: SparkSession, n_rows: int, n_cols: int, density: float, seed: int = 0,
             value_type: str = "bigint", num_partitions: int | None = None) -> Matrix:
    """A random matrix with ``round(density * n_rows * n_cols)`` cells, values 1 to 9.

    The cells, numbered row by row, are dealt into as many equal stretches as cells are
    wanted, and each stretch gives one cell, picked by a hash of its number and the seed. The
    work is in the cells produced, not in the area, no two cells collide, and a task that is
    run again gives the same cells.
    """
    if not 0 <= density <= 1:
        raise ValueError(f"density must lie between 0 and 1, got {density}")
    area = n_rows * n_cols
    count = round(density * area)
    if count == 0:
        return empty(spark, n_rows, n_cols, value_type)
    stretches = spark.range(0, count, 1, num_partitions)
    # Stretch t covers cells t * area / count up to the next, in whole arithmetic that is exact:
    # 64 bits where they suffice, decimals beyond.
    wide = "bigint" if (count + 1) * area < 2**63 else "decimal(20,0)"
    start_of = lambda t: F.expr(
        f"cast(cast({t} as {wide}) * {area} div {count} as bigint)"
    )
    digest = F.md5(F.concat_ws(":", F.col("id").cast("string"), F.lit(str(seed))))
    number = lambda start, size: F.conv(
        F.substring("digest", start, size), 16, 10
    ).cast("bigint")
    picked = (
        stretches.withColumns({"first": start_of("id"), "next": start_of("id + 1")})
        .withColumn("digest", digest)
        .withColumn("cell", F.col("first") + number(1, 12) % (F.col("next") - F.col("first")))
        .withColumn("v", (number(13, 8) % 9 + 1).cast(value_type))
    )
    cells = picked.select(
        F.expr(f"cell div {n_cols}").alias("i"), F.expr(f"cell % {n_cols}").alias("j"), "v"
    )
    return Matrix(cells, n_rows, n_cols, unique=True, nnz=count)
