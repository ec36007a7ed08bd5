"""Helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matrixq.session import scratch_path

#: Word characters' complement in Java patterns: the blanks that end a word.
BLANKS = r"[\x20\x09-\x0D]+"
NOT_BLANKS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, kept when executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int) -> DataFrame:
    """A hint to broadcast a written table, if it has been counted to have no more rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def count_words(text: Column) -> Column:
    """Number of runs of characters that are not blanks; null texts have none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(NOT_BLANKS)).cast("long")
