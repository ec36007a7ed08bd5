"""Every registered query: a function of the session and the folder of tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import matrixq as mq
from matrixq.catalog import tables as t
from matrixq.operators.prefilter import bitmaps, with_partner
from matrixq.operators.rowwise import row_product
from matrixq.operators.verify import product_differences
from matrixq.plans.stats import key_work, product_counts, row_products as counted_rows
from matrixq.session import scratch_path
from matrixq.sources.dense_line import read_dense_line, write_dense_line
from matrixq.sources.tables import read_parquet, read_prepared, write_parquet, write_prepared
from matrixq.sources.text import parse_cells, read_cells, source_info, write_cells


# Products


def mm_join(spark: SparkSession, d: str) -> DataFrame:
    return mq.matmul(t.order_part(spark, d), t.part_supplier(spark, d), "join").cells


def mm_gram_join(spark: SparkSession, d: str) -> DataFrame:
    return mq.gram(t.order_part(spark, d), strategy="join").cells


def mm_gram_copartition(spark: SparkSession, d: str) -> DataFrame:
    m = t.order_part(spark, d)
    return mq.matmul(m.T, m, "copartition").cells


def mm_supplier_gram(spark: SparkSession, d: str) -> DataFrame:
    return mq.gram(t.part_supplier(spark, d), strategy="auto").cells


def mm_rows(spark: SparkSession, d: str) -> DataFrame:
    """The product of ``mm_join`` by parts of its rows, no partial sum shuffled."""
    return mq.matmul(t.order_part(spark, d), t.part_supplier(spark, d), "rows").cells


def mm_rows_gram(spark: SparkSession, d: str) -> DataFrame:
    """Parts by the orders they share; each part names the orders it is in."""
    m = t.order_part(spark, d)
    return mq.matmul(m.T, m, "rows").cells


def mm_rows_long(spark: SparkSession, d: str) -> DataFrame:
    """Line numbers by parts: seven output rows hold all products, so each is split by columns."""
    rows = t.table(spark, d, "lineitem")
    by_line = mq.Matrix.of(
        rows.select("l_linenumber", "l_orderkey", F.col("l_quantity").cast("bigint").alias("v")),
        i="l_linenumber", j="l_orderkey",
    )
    return row_product(by_line, t.order_part(spark, d), part_products=10_000).cells


def row_products(spark: SparkSession, d: str) -> DataFrame:
    """What each row of a product costs, from counts of its factors alone."""
    a, b = mq.coalesce_cells(t.order_part(spark, d)), mq.coalesce_cells(t.part_supplier(spark, d))
    return counted_rows(a, b).select("i", "products", "cells")


def mm_verified(spark: SparkSession, d: str) -> DataFrame:
    """The row-wise product checked against its factors: how many rows it has and how many of them
    do not fit."""
    a, b = t.order_part(spark, d), t.part_supplier(spark, d)
    c = mq.matmul(a, b, "rows")
    checked = product_differences(a, b, c, every_row=True)
    return checked.agg(
        F.count_if(F.col("in_c") & F.col("i").isNotNull()).alias("n_rows"),
        F.count_if("differs").alias("differing"),
    )


def with_partner_cells(spark: SparkSession, d: str) -> DataFrame:
    """Order-part cells whose part is large, told by bitmaps of the parts."""
    large = t.part_size(spark, d).cells.where("v > 25")
    return with_partner(mq.coalesce_cells(t.order_part(spark, d)).cells, "j", bitmaps(large, "i"))


def mm_broadcast(spark: SparkSession, d: str) -> DataFrame:
    return mq.matmul(t.order_part(spark, d), t.part_size(spark, d), "broadcast").cells


def mm_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """Both factors bucketed on the inner index at rest; the join adds no shuffle."""
    prepared = mq.copartition(t.order_supplier(spark, d).T, t.order_part(spark, d))
    name = f"matrixq_{uuid.uuid4().hex}"
    write_prepared(prepared, name, scratch_path(spark, name))
    laid_out = read_prepared(spark, name, prepared)
    product = mq.multiply_prepared(laid_out).cells
    for side in ("left", "right"):  # the plan has their files; the names are not needed further
        spark.sql(f"drop table {name}_{side}")
    return product


def mm_block(spark: SparkSession, d: str) -> DataFrame:
    e = t.vectors(spark, d)
    return mq.matmul(e, _class_sums(spark, d), "block").cells


def mm_component_gram_block(spark: SparkSession, d: str) -> DataFrame:
    """How the components of all vectors go together, 64 x 64."""
    return mq.gram(t.vectors(spark, d).T, of="rows", strategy="block").cells


def mm_block_tiles(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers by the parts they share: several tiles down and across, and several layers."""
    m = t.part_supplier(spark, d)
    return mq.matmul(m.T, m, "block", block=32).cells


def mm_gram_block_tiles(spark: SparkSession, d: str) -> DataFrame:
    return mq.gram(t.part_supplier(spark, d), strategy="block", block=32).cells


def _flag_by_line(spark: SparkSession, d: str) -> tuple[mq.Matrix, mq.Matrix]:
    """Orders by line number, and line numbers by quantity: seven inner indexes hold all cells."""
    rows = t.table(spark, d, "lineitem")
    quantity = F.col("l_quantity").cast("bigint")
    left = mq.Matrix.of(rows.select("l_orderkey", "l_linenumber", quantity.alias("v")),
                        i="l_orderkey", j="l_linenumber")
    right = mq.Matrix.of(rows.select("l_linenumber", quantity.alias("q"), F.lit(1).cast("bigint").alias("v")),
                         i="l_linenumber", j="q")
    return left, right


def mm_hot(spark: SparkSession, d: str) -> DataFrame:
    """Seven inner indexes hold all cells, so each is split over several tasks."""
    return mq.matmul(*_flag_by_line(spark, d), "join", work_floor=10_000).cells


def mm_auto_join(spark: SparkSession, d: str) -> DataFrame:
    """``auto`` where no side may be broadcast."""
    return mq.matmul(t.order_part(spark, d), t.part_supplier(spark, d), broadcast_limit=0).cells


def mm_auto_column_heavy(spark: SparkSession, d: str) -> DataFrame:
    """The mirror of ``mm_auto``: suppliers by parts times parts by orders."""
    return mq.matmul(t.part_supplier(spark, d).T, t.order_part(spark, d).T).cells


def mm_cancelled(spark: SparkSession, d: str) -> DataFrame:
    """A product in which cells cancel, by tiles: they stay as in every other plan."""
    m = t.tax_less_discount(spark, d)
    return mq.matmul(m.T, m, "block", block=32).cells


def mm_cancelled_dropped(spark: SparkSession, d: str) -> DataFrame:
    m = t.tax_less_discount(spark, d)
    return mq.matmul(m.T, m, "join", keep_zeros=False).cells


def mm_auto(spark: SparkSession, d: str) -> DataFrame:
    return mq.matmul(t.order_part(spark, d), t.part_supplier(spark, d)).cells


def mm_matvec(spark: SparkSession, d: str) -> DataFrame:
    return mq.matvec(t.order_part(spark, d), t.part_price(spark, d)).cells


def mm_vecmat(spark: SparkSession, d: str) -> DataFrame:
    return mq.vecmat(t.order_price(spark, d), t.order_part(spark, d)).cells


def _class_sums(spark: SparkSession, d: str) -> mq.Matrix:
    """For each label the sum of its vectors, a thin matrix, component by label."""
    labels = mq.infer_dims(t.vector_label(spark, d))
    return mq.matmul(t.vectors(spark, d).T, labels, "join")


def mm_thin_right(spark: SparkSession, d: str) -> DataFrame:
    return mq.dense_rows_matmul(t.vector_rows(spark, d), _class_sums(spark, d)).cells


def mm_sum_rewrite(spark: SparkSession, d: str) -> DataFrame:
    return mq.sum_of_product(t.order_part(spark, d), t.part_supplier(spark, d))


def product_count(spark: SparkSession, d: str) -> DataFrame:
    a, b = mq.coalesce_cells(t.order_part(spark, d)), mq.coalesce_cells(t.part_supplier(spark, d))
    left, right = a.cells.withColumnRenamed("j", "k"), b.cells.withColumnRenamed("i", "k")
    counted = ("nnz_a", "nnz_b", "products")
    counts = product_counts(key_work(left, right, "i", "j"))
    return counts.select(*(F.col(c).cast("bigint").alias(c) for c in counted))


def scale_columns(spark: SparkSession, d: str) -> DataFrame:
    scaled = mq.scale_columns(mq.coalesce_cells(t.part_supplier(spark, d)), t.order_supplier(spark, d))
    return scaled.cells


# Cells


def transpose(spark: SparkSession, d: str) -> DataFrame:
    return mq.transpose(mq.coalesce_cells(t.part_supplier(spark, d))).cells


def coalesce_sum(spark: SparkSession, d: str) -> DataFrame:
    return mq.coalesce_cells(t.order_part(spark, d)).cells


def dedup_last(spark: SparkSession, d: str) -> DataFrame:
    rows = t.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("i"), F.col("l_partkey").alias("j"),
        F.col("l_quantity").cast("bigint").alias("v"), "l_linenumber", "l_quantity",
    )
    return mq.coalesce_cells(mq.Matrix(rows), "last", ("l_linenumber", "l_quantity")).cells


def dedup_error(spark: SparkSession, d: str) -> DataFrame:
    """Prices by order and customer hold no cell twice, so the check lets them pass."""
    rows = t.table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", t.cents(F.col("o_totalprice")).alias("v")
    )
    return mq.coalesce_cells(mq.Matrix.of(rows, i="o_orderkey", j="o_custkey"), "error").cells


def drop_zeros(spark: SparkSession, d: str) -> DataFrame:
    return mq.drop_zeros(t.tax_less_discount(spark, d)).cells


def semi_filter(spark: SparkSession, d: str) -> DataFrame:
    large = t.part_size(spark, d)
    large = large.with_cells(large.cells.where("v > 25"))
    return mq.keep_matching_columns(mq.coalesce_cells(t.order_part(spark, d)), large).cells


# Aggregates


def info(spark: SparkSession, d: str) -> DataFrame:
    return mq.info(t.order_part(spark, d))


def index_range(spark: SparkSession, d: str) -> DataFrame:
    return mq.index_range(t.order_part(spark, d))


def nnz(spark: SparkSession, d: str) -> DataFrame:
    return mq.nnz(t.order_part(spark, d))


def total(spark: SparkSession, d: str) -> DataFrame:
    return mq.total(t.order_part(spark, d))


def row_sums(spark: SparkSession, d: str) -> DataFrame:
    return mq.row_sums(t.part_supplier(spark, d)).cells


def column_sums(spark: SparkSession, d: str) -> DataFrame:
    return mq.column_sums(t.part_supplier(spark, d)).cells


def index_distinct(spark: SparkSession, d: str) -> DataFrame:
    return mq.distinct_indexes(t.order_part(spark, d), "j")


def column_map(spark: SparkSession, d: str) -> DataFrame:
    """Entry count and value sum of each column, read back from its maps."""
    maps = mq.column_map(t.order_part(spark, d), chunk=4096)
    held = maps.select(
        "j", F.size("entries").alias("n"),
        F.aggregate(
            F.map_values("entries"), F.lit(0).cast("bigint"), lambda acc, x: acc + x
        ).alias("s"),
    )
    return held.groupBy("j").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


# Looks


def preview(spark: SparkSession, d: str) -> DataFrame:
    return mq.preview(t.order_part(spark, d))


def preview_table(spark: SparkSession, d: str) -> DataFrame:
    return mq.preview_table(t.vectors(spark, d))


def sample(spark: SparkSession, d: str) -> DataFrame:
    return mq.sample(t.order_part(spark, d))


# Forms


def dense_rows(spark: SparkSession, d: str) -> DataFrame:
    """The first and the last value and the sum of each dense row of components."""
    rows = mq.to_dense_rows(mq.infer_dims(t.vectors(spark, d)))
    return rows.select(
        "i", F.size("vals").alias("width"), F.get("vals", F.lit(0)).alias("first"),
        F.element_at("vals", -1).alias("last"),
        F.aggregate("vals", F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("s"),
    )


def dense_rows_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    e = mq.infer_dims(t.vectors(spark, d))
    return mq.from_dense_rows(mq.to_dense_rows(e), *e.shape).cells


def blocks(spark: SparkSession, d: str) -> DataFrame:
    """Size and value sum of each block, edge blocks being smaller."""
    formed = mq.to_blocks(t.vectors(spark, d), 48)
    held = F.aggregate("data", F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return formed.select(
        "bi", "bj", "n_rows", "n_cols", F.size("data").alias("n"), held.alias("s")
    )


def block_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    e = mq.infer_dims(t.vectors(spark, d))
    return mq.from_blocks(mq.to_blocks(e, 256), *e.shape, 256).cells


# Files


def _written(spark: SparkSession, m: mq.Matrix, write, name: str) -> str:
    path = scratch_path(spark, name)
    write(m, path)
    return path


def coo_text_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    m = mq.coalesce_cells(t.order_part(spark, d))
    back = read_cells(spark, _written(spark, m, write_cells, "text"))
    return back.cells.withColumn("v", F.col("v").cast("bigint"))


def parquet_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    m = mq.coalesce_cells(t.order_part(spark, d))
    return read_parquet(spark, _written(spark, m, write_parquet, "parquet"), unique=True).cells


def source_size(spark: SparkSession, d: str) -> DataFrame:
    """Bytes that a written text matrix takes."""
    m = mq.coalesce_cells(t.order_part(spark, d))
    files = source_info(spark, _written(spark, m, write_cells, "size"))
    return files.agg(F.sum("size_bytes").alias("size_bytes"))


def dense_line_reshape(spark: SparkSession, d: str) -> DataFrame:
    e = mq.infer_dims(t.vectors(spark, d))
    path = _written(spark, e, write_dense_line, "line")
    return read_dense_line(spark, path, *e.shape).cells.withColumn("v", F.col("v").cast("bigint"))


def dense_line_counted(spark: SparkSession, d: str) -> DataFrame:
    """The same with the number of columns counted."""
    e = mq.infer_dims(t.vectors(spark, d))
    path = _written(spark, e, write_dense_line, "line")
    return read_dense_line(spark, path, e.n_rows).cells.withColumn("v", F.col("v").cast("bigint"))


def _line_forms(forms: dict[int, str]):
    """A line for each lineitem row, its form picked by the line number."""
    order, part = (F.col(c).cast("string") for c in ("l_orderkey", "l_partkey"))
    quantity = F.col("l_quantity").cast("bigint").cast("string")
    form = F.lit("")
    for number, pattern in forms.items():
        text = F.replace(F.lit(pattern), F.lit("I"), order)
        text = F.replace(F.replace(text, F.lit("J"), part), F.lit("Q"), quantity)
        form = F.when(F.col("l_linenumber") == number, text).otherwise(form)
    return form


# What a line looks like for each line number; I, J and Q stand for order, part
# and quantity. Line numbers not listed give a blank line.
PERMISSIVE_LINES = {
    1: "I,J,Q", 2: "I.0,J.0,Qe0", 4: "bad", 5: "I,J", 6: "I,J,x", 7: " I, J, Q ", 8: "I,J,Q,9",
}
COUNTED_LINES = {1: "I,J,Q", 2: " I, J, Q.5 ", 4: "I,J,Q,9", 5: "I,J", 6: "I,J,Qe1", 7: "-I,J,Q"}
STRICT_LINES = {
    1: "I,J,Q", 2: " I, J, Q.5 ", 3: "I,J,Q", 4: "I,J,Q,9", 5: "I,J,Q,x,y", 6: "I,J,Qe1",
    7: "I,J,-Q",
}


def _parsed(spark: SparkSession, d: str, forms: dict[int, str], policy: str) -> DataFrame:
    cells = parse_cells(t.lineitem_lines(spark, d, _line_forms(forms)), policy).cells
    # Values have one decimal at most.
    tenths = F.round(F.col("v") * 10).cast("bigint")
    return cells.select("i", "j", tenths.alias("tenths"))


def parse_permissive(spark: SparkSession, d: str) -> DataFrame:
    return _parsed(spark, d, PERMISSIVE_LINES, "permissive")


def parse_counted(spark: SparkSession, d: str) -> DataFrame:
    return _parsed(spark, d, COUNTED_LINES, "skip_bad_shape")


def parse_strict(spark: SparkSession, d: str) -> DataFrame:
    return _parsed(spark, d, STRICT_LINES, "strict")


QUERIES = {
    f.__name__: f
    for f in (
        mm_join, mm_gram_join, mm_gram_copartition, mm_supplier_gram, mm_broadcast, mm_bucketed,
        mm_block, mm_component_gram_block, mm_block_tiles, mm_gram_block_tiles, mm_hot,
        mm_auto_join, mm_auto_column_heavy, mm_cancelled, mm_cancelled_dropped, mm_auto, mm_matvec, mm_vecmat, mm_thin_right, mm_sum_rewrite,
        product_count, scale_columns, transpose, coalesce_sum, dedup_last, dedup_error,
        drop_zeros, semi_filter, info, index_range, nnz, total, row_sums, column_sums, index_distinct,
        column_map, preview, preview_table, sample, dense_rows, dense_rows_roundtrip, blocks,
        block_roundtrip, coo_text_roundtrip, parquet_roundtrip, source_size, dense_line_reshape,
        dense_line_counted,
        parse_permissive, parse_counted, parse_strict, mm_rows, mm_rows_gram, mm_rows_long, mm_verified, row_products,
        with_partner_cells,
    )
}
