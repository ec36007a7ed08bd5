"""Matrices as one line of comma-separated values, row by row.

Such a line may be as large as the matrix, so it is never read as one record. The comma is
given to Spark as the line separator: the file then splits like any text file and each value
is a record. What is left is the number of each value, which is its place in its stretch of
the file plus the count of values in the stretches before.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matrixq.functions.parsing import to_number
from matrixq.model import Matrix
from matrixq.operators.convert import to_dense_rows
from matrixq.plans.limits import fits_broadcast
from matrixq.session import scratch_path

ON_BAD = ("error", "shift")
# Files whose numbers are summed up together.
FILES_PER_BUCKET = 1024


def read_dense_line(spark: SparkSession, path: str, n_rows: int, n_cols: int | None = None, *,
                    on_bad: str = "error", keep_zeros: bool = True) -> Matrix:
    """A matrix of ``n_rows x n_cols`` from one line, in one file or in the parts of a folder
    in the order of their numbers. Without ``n_cols`` the values are counted and dealt out over the rows.

    The file is parsed once, into the shared folder; the values are counted and checked there before
    the matrix is returned, and each gets its number from the counts of the file splits.

    ``on_bad='error'``: a value that is no number, a second line, or a count of values other than
    ``n_rows * n_cols`` (other than a multiple of ``n_rows``, if that is all that is known).
    ``on_bad='shift'``: values that are no numbers are left out and later ones move up. A count
    that does not match is warned about: extra values are cut off, missing cells are absent.
    """
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad must be one of {ON_BAD}, got {on_bad!r}")
    shift = on_bad == "shift"
    # Read and parsed once: all that follows works on the written records.
    parsed = scratch_path(spark, "values")
    _records(spark, path, skip_bad=shift).write.parquet(parsed)
    records = spark.read.parquet(parsed)
    splits = scratch_path(spark, "splits")
    records.groupBy("file", "start").agg(
        F.count("*").alias("n"), F.min("place").alias("first"),
        F.min_by("opens_line", "place").alias("opens"), F.sum(F.col("opens_line").cast("long")).alias("opened"),
        F.max_by("closes_line", "place").alias("closes"), F.sum(F.col("closes_line").cast("long")).alias("closed"),
        F.min("bad").alias("bad"), F.max("inside").alias("inside"),
    ).write.parquet(splits)
    stretches = spark.read.parquet(splits)
    # Parts are numbered in their names, which sort as text only up to 99,999.
    number = F.expr(r"try_cast(regexp_extract(file, 'part-(\\d+)[^/]*$', 1) as bigint)")
    offsets = numbered(stretches.withColumn("number", number))
    seen = stretches.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"), F.min("bad").alias("bad"),
        F.max("inside").alias("inside"),
        F.coalesce(F.sum("opened"), F.lit(0)).alias("opened"),
        F.coalesce(F.sum("closed"), F.lit(0)).alias("closed"),
        F.min_by("opens", F.struct(number, "file", "start")).alias("opens"),
        F.max_by("closes", F.struct(number, "file", "start")).alias("closes"),
        F.count("*").alias("stretches"),
    ).first()
    # A line may begin before the first value and end after the last one, nowhere else.
    broken = seen["opened"] > bool(seen["opens"]) or seen["closed"] > bool(seen["closes"])
    if broken or seen["inside"]:
        raise ValueError(f"more than one line in {path}")
    if seen["bad"] is not None and not shift:
        raise ValueError(f"not a number: {seen['bad']!r} in {path}")
    count = seen["count"]
    if n_cols is None:
        n_cols = count // n_rows if n_rows else 0
    area = n_rows * n_cols
    if count != area:
        if not shift:
            raise ValueError(f"expected {n_rows} x {n_cols} values, found {count} in {path}")
        warnings.warn(f"{count} values for {n_rows} x {n_cols} cells in {path}", stacklevel=2)
    at = (F.col("place") + F.col("shift")).alias("at")
    if fits_broadcast(seen["stretches"]):
        offsets = F.broadcast(offsets)
    values = records.join(offsets, ["file", "start"]).select(at, "v").where(F.col("at") < area)
    width = max(1, n_cols)
    cells = values.select(
        F.expr(f"at div {width}").alias("i"), F.expr(f"at % {width}").alias("j"), "v"
    )
    if not keep_zeros:
        cells = cells.where("v <> 0")
    return Matrix(cells, n_rows, n_cols, unique=True, nnz=area)


def numbered(stretches: DataFrame) -> DataFrame:
    """Rows ``(file, start, shift)``: what to add to a place within a stretch. From rows
    ``(file, number, start, n, first)``, one per file split, ``n`` values each.

    The values before a stretch are those before it in its file, those of earlier files in its
    bucket of file numbers, and those of earlier buckets. The first two are sums within a file and
    a bucket; only the buckets, one for each ``FILES_PER_BUCKET`` files, are summed by the driver.
    Files without a number come first and share a bucket.
    """
    bucket = F.expr(f"coalesce(number div {FILES_PER_BUCKET}, -1)")
    files = stretches.groupBy("file", "number").agg(F.sum("n").alias("n")).withColumn("bucket", bucket)
    before, totals = 0, []
    for row in files.groupBy("bucket").agg(F.sum("n").alias("n")).orderBy("bucket").collect():
        totals.append((row["bucket"], before))
        before += row["n"]
    earlier = files.sparkSession.createDataFrame(totals, "bucket bigint, earlier bigint")
    up_to = lambda window: window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_bucket = up_to(Window.partitionBy("bucket").orderBy("number", "file"))
    of_file = files.withColumn("before", F.sum("n").over(in_bucket) - F.col("n")).join(
        F.broadcast(earlier), "bucket"
    ).select("file", (F.col("before") + F.col("earlier")).alias("offset"))
    in_file = up_to(Window.partitionBy("file").orderBy("start"))
    inside = F.sum("n").over(in_file) - F.col("n") - F.col("first")
    return stretches.select("file", "start", inside.alias("inside")).join(of_file, "file").select(
        "file", "start", (F.col("inside") + F.col("offset")).alias("shift")
    )


def _records(spark: SparkSession, path: str, skip_bad: bool) -> DataFrame:
    """Rows ``(file, start, place, v, opens_line, closes_line, inside, bad)``: where a value stands,
    the number, whether a line begins before it, ends behind it or inside of it, and its text if
    it is no number."""
    text = F.regexp_replace("value", r"^\s+|\s+$", "")
    inside = text.contains("\n")
    records = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        # Consecutive within a stretch, which one task reads from end to end.
        F.monotonically_increasing_id().alias("place"),
        to_number(text).alias("v"),
        F.col("value").rlike(r"^\s*\n").alias("opens_line"),
        F.col("value").rlike(r"\n\s*$").alias("closes_line"),
        inside.alias("inside"), F.when(to_number(text).isNull(), F.col("value")).alias("bad"),
    )
    if skip_bad:
        # Only numbers take a place. The window holds one stretch, which is one file split.
        within = Window.partitionBy("file", "start").orderBy("place")
        records = records.where("v is not null or inside").withColumn(
            "place", F.row_number().over(within).cast("bigint")
        )
    return records


def write_dense_line(m: Matrix, path: str, mode: str = "errorifexists") -> None:
    """A folder whose parts, in name order, make one line of all values row by row, each
    followed by a comma. Rows are sorted by range, so no task writes more than its share."""
    rows = to_dense_rows(m, all_rows=True).orderBy("i")
    line = F.concat_ws(",", F.transform("vals", lambda x: x.cast("string")))
    rows.select(line.alias("value")).write.mode(mode).option("lineSep", ",").text(path)
