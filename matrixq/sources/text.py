"""Matrices as text, one cell ``i,j,value`` per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matrixq.functions.parsing import cells_of_lines, line_of_cell
from matrixq.model import Matrix


def parse_cells(lines: DataFrame, policy: str = "permissive", *, line: str = "value",
                n_rows: int | None = None, n_cols: int | None = None) -> Matrix:
    """A matrix from a DataFrame of lines; see ``cells_of_lines`` for the policies.

    Cells with a negative index are left out.
    """
    cells = cells_of_lines(lines, line, policy).where("i >= 0 and j >= 0")
    return Matrix(cells, n_rows, n_cols)


def read_cells(spark: SparkSession, path: str | list[str], policy: str = "permissive", *,
               n_rows: int | None = None, n_cols: int | None = None) -> Matrix:
    """A matrix from files or folders under any path Spark can read."""
    return parse_cells(spark.read.text(path), policy, n_rows=n_rows, n_cols=n_cols)


def write_cells(m: Matrix, path: str, mode: str = "errorifexists",
                compression: str = "none") -> None:
    """A folder of lines ``i,j,value``."""
    line = line_of_cell(F.col("i"), F.col("j"), F.col("v")).alias("value")
    m.cells.select(line).write.mode(mode).option("compression", compression).text(path)


def source_info(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows ``(path, size_bytes, size_mb)``, one per file; a missing path fails.

    Only the listing is read, never the content.
    """
    listing = spark.read.format("binaryFile").load(path)
    return listing.select(
        "path",
        F.col("length").alias("size_bytes"),
        (F.col("length") / (1024 * 1024)).alias("size_mb"),
    )
