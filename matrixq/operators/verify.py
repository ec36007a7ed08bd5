"""Checks of a product without forming it again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matrixq.model import Matrix, value_type_of
from matrixq.operators.cells import coalesce_cells
from matrixq.operators.product import check_conformable

# Whole numbers are compared in the field of this prime, so the products of two fit 64 bits.
PRIME = (1 << 31) - 1


def _factor(j: str, seed: int, whole: bool) -> Column:
    """The random factor of a column, worked out from its number wherever it is needed."""
    h = F.pmod(F.xxhash64(F.lit(seed), F.col(j)), F.lit(PRIME))
    return h if whole else 1 + h / PRIME


def _times(left: Column, right: Column, whole: bool) -> Column:
    if not whole:
        return left.cast("double") * right
    return F.pmod(F.pmod(left.cast("bigint"), F.lit(PRIME)) * right, F.lit(PRIME))


def _summed(of: Column, whole: bool) -> Column:
    total = F.sum(of)
    return F.pmod(total, F.lit(PRIME)).cast("bigint") if whole else total


def product_differences(a: Matrix, b: Matrix, c: Matrix, *, seed: int = 0,
                        tolerance: float = 1e-9, every_row: bool = False) -> DataFrame:
    """Rows ``(i, expected, found)`` of ``C`` that do not fit ``A x B``; none if it is the product.

    Freivalds' check: ``A (B x)`` against ``C x`` for a random vector ``x``. That is three passes,
    over each matrix once, whatever number of products ``A x B`` has. Whole numbers are compared
    modulo a prime, so a wrong row stays unseen with a chance of 1 in 2**31; doubles within
    ``tolerance`` of the sum of their absolute values. ``x`` comes from a hash of the column, so it
    is neither stored nor sent. ``every_row``: all rows of ``A x B`` and of ``C`` instead, with
    ``in_c`` and ``differs``, so that one pass over ``C`` tells more than the differences.
    """
    check_conformable(a, b)
    whole = value_type_of(a, b, c) == "bigint"
    a, b, c = (coalesce_cells(m).cells for m in (a, b, c))
    zero = F.lit(0).cast("bigint" if whole else "double")

    def of_rows(cells: DataFrame) -> DataFrame:
        term = _times(F.col("v"), _factor("j", seed, whole), whole)
        sums = [_summed(term, whole).alias("y"), F.sum(F.abs(term)).alias("size")]
        return cells.groupBy("i").agg(*sums)

    inner = of_rows(b).withColumnRenamed("i", "k")
    met = a.select("i", F.col("j").alias("k"), "v").join(inner, "k")
    term = _times(F.col("v"), F.col("y"), whole)
    expected = met.groupBy("i").agg(
        _summed(term, whole).alias("expected"),
        F.sum(F.abs("v").cast("double") * F.col("size")).alias("scale"),
    )
    found = of_rows(c).select("i", F.col("y").alias("found"), F.col("size"))
    both = expected.join(found, "i", "full").select(
        "i", F.coalesce("expected", zero).alias("expected"), F.coalesce("found", zero).alias("found"),
        F.greatest("scale", "size").alias("scale"), F.col("found").isNotNull().alias("in_c"),
    )
    apart = F.col("expected") != F.col("found")
    if not whole:
        gap = F.abs(F.col("expected") - F.col("found"))
        apart = apart & ~F.coalesce(gap <= tolerance * F.col("scale"), F.lit(False))
    if every_row:
        differs = F.coalesce(apart, F.lit(False)).alias("differs")
        return both.select("i", "expected", "found", "in_c", differs)
    return both.where(apart).select("i", "expected", "found")


def is_product(a: Matrix, b: Matrix, c: Matrix, **options) -> bool:
    """Whether ``product_differences`` finds nothing. Runs a job."""
    return product_differences(a, b, c, **options).limit(1).count() == 0
