"""Column expressions that build dense arrays from sparse positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fill_gaps(placed: Column, length: Column, zero: Column) -> Column:
    """A dense array of ``length`` values from ``array<struct<p, x>>`` with distinct ``p``.

    ``placed`` must be a column already in position order, not an expression: it is read once
    per entry. One linear pass: each entry brings along the zeros between it and the one before.
    """
    nothing_before = F.lit(-1).cast("bigint")

    def with_gap(entry: Column, at: Column) -> Column:
        before = F.coalesce(F.get(placed, at - 1)["p"], nothing_before)
        zeros = F.array_repeat(zero, (entry["p"] - before - 1).cast("int"))
        return F.concat(zeros, F.array(entry["x"]))

    last = F.coalesce(F.get(placed, F.size(placed) - 1)["p"], nothing_before)
    tail = F.array_repeat(zero, (length - last - 1).cast("int"))
    return F.concat(F.flatten(F.transform(placed, with_gap)), tail)
