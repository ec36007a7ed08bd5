"""The benchmark's families of matrix shapes."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from matrixq.bench.runs import append_runs, run_strategies
from matrixq.model import Matrix
from matrixq.sources.cells import generate


@dataclass(frozen=True)
class Workload:
    """``A`` is ``n_rows x n_inner``, ``B`` is ``n_inner x n_cols``, both of one density."""

    name: str
    n_rows: int
    n_inner: int
    n_cols: int
    density: float

    def matrices(self, spark: SparkSession, value_type: str = "double") -> tuple[Matrix, Matrix]:
        a = generate(spark, self.n_rows, self.n_inner, self.density, 1, value_type)
        b = generate(spark, self.n_inner, self.n_cols, self.density, 2, value_type)
        return a, b


# Shapes and densities of the seven families. Families 3 to 7 state no
# density; 5 % is taken, and full vectors.
SQUARES = [Workload(f"square_{n}", n, n, n, 0.05) for n in (1000, 2000, 5000)]
DENSITIES = [
    Workload(f"density_{percent:g}", 2000, 2000, 2000, percent / 100)
    for percent in (0.1, 1, 5, 50, 100)
]
ROW_HEAVY = Workload("row_heavy", 5000, 500, 2000, 0.05)
COLUMN_HEAVY = Workload("column_heavy", 500, 3000, 5000, 0.05)
MATRIX_VECTOR = Workload("matrix_vector", 2000, 1000, 1, 0.05)
VECTOR_MATRIX = Workload("vector_matrix", 1, 1000, 2000, 0.05)
THIN_RIGHT = [Workload(f"thin_{n}", 3000, 2000, n, 0.05) for n in (40, 80)]
TRANSPOSED = Workload("transposed", 3000, 2000, 3000, 0.05)

ALL = [
    *SQUARES, *DENSITIES, ROW_HEAVY, COLUMN_HEAVY, MATRIX_VECTOR, VECTOR_MATRIX, *THIN_RIGHT,
    TRANSPOSED,
]


def run_workloads(spark: SparkSession, workloads: Iterable[Workload],
                  strategies: Iterable[str], path: str) -> None:
    """Run each workload with each strategy and keep the runs in a parquet folder, each
    workload as soon as it is done."""
    strategies = list(strategies)
    for workload in workloads:
        a, b = workload.matrices(spark)
        append_runs(run_strategies(a, b, strategies, workload.name), path)
