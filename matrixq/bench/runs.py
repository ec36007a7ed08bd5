"""Timed products and their comparison.

Every strategy is timed over the same span: from planning the product to the last cell of a
complete ``C`` handed to a sink, on inputs that were read and persisted before.
"""

from __future__ import annotations

import time
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matrixq.model import Matrix
from matrixq.operators.aggregates import infer_dims
from matrixq.operators.product import check_conformable, matmul
from matrixq.sources.text import read_cells

RUN_SCHEMA = (
    "workload string, strategy string, n_rows bigint, n_cols bigint, nnz bigint, "
    "total double, seconds double, fingerprint double"
)


@contextmanager
def job_group(spark: SparkSession, name: str):
    """Label all jobs inside, so that they can be told apart in the event log."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        yield
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)


@contextmanager
def persisted(*matrices: Matrix):
    """The matrices persisted and filled."""
    held = [m.persist() for m in matrices]
    try:
        for m in held:
            m.cells.count()
        yield held
    finally:
        for m in held:
            m.unpersist()


def timed_product(a: Matrix, b: Matrix, strategy: str, workload: str = "", **options) -> dict:
    """One run: every cell of ``C`` is computed and goes into its count, its sum and a sum of
    values weighted by a hash of their place, which tells equal products from others."""
    with job_group(a.spark, f"{workload}/{strategy}"):
        started = time.perf_counter()
        c = matmul(a, b, strategy, **options)
        v = F.col("v").cast("double")
        weight = F.pmod(F.xxhash64("i", "j"), F.lit(1009)) + 1
        row = c.cells.agg(
            F.count_if(v != 0).alias("n"), F.sum(v).alias("s"), F.sum(v * weight).alias("f")
        )
        result = row.first()
        seconds = time.perf_counter() - started
    return {
        "workload": workload, "strategy": strategy, "n_rows": c.n_rows, "n_cols": c.n_cols,
        "nnz": result["n"], "total": result["s"] or 0.0, "seconds": seconds,
        "fingerprint": result["f"] or 0.0,
    }


def run_strategies(a: Matrix, b: Matrix, strategies: Iterable[str], workload: str = "",
                   **options) -> DataFrame:
    """Rows of ``RUN_SCHEMA``, one per strategy, on persisted inputs."""
    check_conformable(a, b)
    with persisted(a, b) as (left, right):
        runs = [timed_product(left, right, s, workload, **options) for s in strategies]
    return a.spark.createDataFrame(runs, RUN_SCHEMA)


def compare_runs(runs: DataFrame, baseline: str) -> DataFrame:
    """Each run beside the baseline strategy of its workload: how much time it saves in
    percent, how many times as fast it is, and whether both found the same product."""
    base = runs.where(F.col("strategy") == baseline).groupBy("workload").agg(
        F.avg("seconds").alias("base_seconds"), F.first("total").alias("base_total"),
        F.first("nnz").alias("base_nnz"), F.first("fingerprint").alias("base_fingerprint"),
    )
    ratio = F.try_divide(F.col("base_seconds"), F.col("seconds"))
    saved: Column = F.try_divide(F.col("base_seconds") - F.col("seconds"), F.col("base_seconds"))
    near = lambda x: F.abs(F.col(x) - F.col(f"base_{x}")) <= F.greatest(
        F.lit(1e-9), F.abs(f"base_{x}") * 1e-9
    )
    agrees = (F.col("nnz") == F.col("base_nnz")) & near("total") & near("fingerprint")
    return runs.join(base, "workload").select(
        "workload", "strategy", "nnz", "total", "seconds",
        (saved * 100).alias("saved_percent"), ratio.alias("times_as_fast"),
        agrees.alias("agrees"),
    )


def compare_files(spark: SparkSession, a_path: str, b_path: str,
                  strategies: Iterable[str] = ("join", "broadcast"), *,
                  policy: str = "permissive", workload: str = "files") -> DataFrame:
    """Read two text matrices, check them, multiply them with each strategy, compare.

    The first strategy is the baseline. Shapes are inferred from the cells.
    """
    strategies = list(strategies)
    a, b = (infer_dims(read_cells(spark, path, policy)) for path in (a_path, b_path))
    # An inferred inner size is only a lower bound: both take the greater one.
    inner = max(a.n_cols, b.n_rows)
    a, b = a.with_cells(a.cells, n_cols=inner), b.with_cells(b.cells, n_rows=inner)
    return compare_runs(run_strategies(a, b, strategies, workload), strategies[0])


def append_runs(runs: DataFrame, path: str) -> None:
    """Keep runs in a parquet folder."""
    runs.write.mode("append").parquet(path)
