"""Matrices over the given tables, values scaled to whole numbers so that sums are exact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matrixq.model import Matrix
from matrixq.operators.convert import from_dense_rows

EMBEDDING_WIDTH = 64
SIZE_CLASSES = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("bigint")


def _lineitem_matrix(spark, sf_dir, i: str, j: str, v: Column) -> Matrix:
    rows = table(spark, sf_dir, "lineitem")
    return Matrix.of(rows.select(i, j, v.alias("v")), i=i, j=j)


def order_part(spark: SparkSession, sf_dir: str) -> Matrix:
    """Quantity ordered, order by part."""
    quantity = F.col("l_quantity").cast("bigint")
    return _lineitem_matrix(spark, sf_dir, "l_orderkey", "l_partkey", quantity)


def part_supplier(spark: SparkSession, sf_dir: str) -> Matrix:
    """Quantity ordered, part by supplier."""
    quantity = F.col("l_quantity").cast("bigint")
    return _lineitem_matrix(spark, sf_dir, "l_partkey", "l_suppkey", quantity)


def order_supplier(spark: SparkSession, sf_dir: str) -> Matrix:
    """Quantity ordered, order by supplier."""
    quantity = F.col("l_quantity").cast("bigint")
    return _lineitem_matrix(spark, sf_dir, "l_orderkey", "l_suppkey", quantity)


def tax_less_discount(spark: SparkSession, sf_dir: str) -> Matrix:
    """Percent of tax less percent of discount, part by supplier; many cells cancel to zero."""
    points = cents(F.col("l_tax")) - cents(F.col("l_discount"))
    return _lineitem_matrix(spark, sf_dir, "l_partkey", "l_suppkey", points)


def part_size(spark: SparkSession, sf_dir: str) -> Matrix:
    """Part size, part by last digit of the size; one cell per part."""
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", (F.col("p_size") % SIZE_CLASSES).alias("digit"),
        F.col("p_size").cast("bigint").alias("v"),
    )
    return Matrix.of(rows, None, SIZE_CLASSES, i="p_partkey", j="digit", unique=True)


def part_price(spark: SparkSession, sf_dir: str) -> Matrix:
    """Retail price in cents, a column vector over parts."""
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.lit(0).alias("j"), cents(F.col("p_retailprice")).alias("v")
    )
    return Matrix.of(rows, None, 1, i="p_partkey", unique=True)


def order_price(spark: SparkSession, sf_dir: str) -> Matrix:
    """Total price in cents, a row vector over orders."""
    rows = table(spark, sf_dir, "orders").select(
        F.lit(0).alias("i"), "o_orderkey", cents(F.col("o_totalprice")).alias("v")
    )
    return Matrix.of(rows, 1, None, j="o_orderkey", unique=True)


def vector_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows ``(i, vals)``: the embeddings in fixed point with four decimals."""
    fixed = F.transform("embedding", lambda x: F.round(x.cast("double") * 10000).cast("bigint"))
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("i"), fixed.alias("vals"))


def vectors(spark: SparkSession, sf_dir: str) -> Matrix:
    """The embeddings as cells, vector by component."""
    return from_dense_rows(vector_rows(spark, sf_dir), None, EMBEDDING_WIDTH)


def vector_label(spark: SparkSession, sf_dir: str) -> Matrix:
    """One in the column of its label for every vector."""
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.lit(1).cast("bigint").alias("v")
    )
    return Matrix.of(rows, i="vec_id", j="label", unique=True)


def lineitem_lines(spark: SparkSession, sf_dir: str, form: Column) -> DataFrame:
    """Text lines ``(value)``, one per lineitem row."""
    return table(spark, sf_dir, "lineitem").select(form.alias("value"))
