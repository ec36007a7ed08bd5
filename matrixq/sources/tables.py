"""Matrices as parquet folders, and prepared factors as bucketed tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import SparkSession

from matrixq.model import Matrix
from matrixq.operators.product import Prepared


def write_parquet(m: Matrix, path: str, mode: str = "errorifexists", sort_by: str = "i") -> None:
    """Cells sorted within each file, so that row groups can be skipped on that index."""
    m.cells.sortWithinPartitions(sort_by).write.mode(mode).parquet(path)


def read_parquet(spark: SparkSession, path: str, n_rows: int | None = None,
                 n_cols: int | None = None, *, unique: bool = False) -> Matrix:
    return Matrix(spark.read.parquet(path).select("i", "j", "v"), n_rows, n_cols, unique)


def write_prepared(p: Prepared, table: str, path: str | None = None,
                   mode: str = "errorifexists") -> None:
    """Two tables, ``<table>_left`` and ``<table>_right``, bucketed on the join keys.

    The parts of a split hot index are keys too and land in buckets of their own. With
    ``path`` the files go there instead of into the warehouse.
    """
    for side, df in (("left", p.left), ("right", p.right)):
        writer = df.write.mode(mode).format("parquet").bucketBy(p.num_partitions, *p.keys)
        if path is not None:
            writer = writer.option("path", f"{path}/{side}")
        writer.sortBy(*p.keys).saveAsTable(f"{table}_{side}")


def read_prepared(spark: SparkSession, table: str, like: Prepared) -> Prepared:
    """The tables of ``write_prepared``; their join shuffles neither of them."""
    return replace(
        like, left=spark.table(f"{table}_left"), right=spark.table(f"{table}_right")
    )
