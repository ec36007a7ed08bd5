"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from matrixq.plans.limits import CELLS_PER_TASK, MAX_PARTITIONS

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of a batch of texts on its way to Python.
BATCH_BYTES = 4 << 20
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def local_session(cores: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("matrixq")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune_scan(spark: SparkSession, *, min_partitions: int | None = None,
              max_partition_bytes: int | None = None) -> None:
    """Scan parallelism: at least ``min_partitions`` splits, none above ``max_partition_bytes``.

    The read buffer of the Hadoop client is a session setting,
    ``spark.hadoop.io.file.buffer.size``.
    """
    if min_partitions is not None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(min_partitions))
    if max_partition_bytes is not None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(max_partition_bytes))


def tune_shuffle(spark: SparkSession, rows: int) -> int:
    """Start shuffles of about ``rows`` cells or partial sums with enough partitions.

    Adaptive execution joins partitions that turn out small, but it cannot add any to a sum.
    Returns the number set; a larger one that is set already is kept.
    """
    wanted = min(MAX_PARTITIONS, -(-rows // CELLS_PER_TASK))
    default = spark.conf.get("spark.sql.shuffle.partitions")
    current = int(spark.conf.get(INITIAL_PARTITIONS, default))
    partitions = max(wanted, current)
    spark.conf.set(INITIAL_PARTITIONS, str(partitions))
    return partitions


def tune_for(spark: SparkSession, *cells: DataFrame) -> int:
    """``tune_shuffle`` for the cells of some DataFrames, which are counted: a quarter of
    ``CELLS_PER_TASK`` to a partition, as sums of cells hold a table beside what they read."""
    return tune_shuffle(spark, 4 * sum(each.count() for each in cells))


def tune_texts(spark: SparkSession) -> None:
    """Batches that go to Python by bytes, as 10,000 texts may be any number of them. A batch is
    held by the JVM and, several times over, by the worker.

    A session setting, ``spark.sql.execution.arrow.maxBytesPerBatch``; a smaller one is kept.
    """
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([a-z]?)b?\s*", spark.conf.get(ARROW_BYTES).lower()).groups()
    current = int(number) << 10 * " kmgtp".find(unit) if unit not in ("", "b") else int(number)
    if current <= 0 or current > BATCH_BYTES:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate, in the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``; where it names none, the
    warehouse is the folder that is shared.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return f"{base.rstrip('/')}/matrixq-{name}-{uuid.uuid4().hex}"
