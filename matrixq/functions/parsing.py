"""Column expressions that turn a text line into a cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POLICIES = ("permissive", "skip_bad_shape", "strict")


def to_number(text: Column) -> Column:
    """The text as a double, NULL when it is no number."""
    return F.trim(text).try_cast("double")


def to_rounded_index(number: Column) -> Column:
    """A float index as a whole one, halves to even; NULL for NaN and infinities."""
    return F.rint(number).try_cast("bigint")


def to_whole_index(text: Column) -> Column:
    """An index written as a whole number; ``'1.0'`` gives NULL."""
    return F.trim(text).try_cast("bigint")


def or_fail(value: Column, parts: Column) -> Column:
    """``value``, or a failed task that shows the offending line."""
    line = F.concat(F.lit("not a matrix cell: "), F.array_join(parts, ","))
    return F.coalesce(value, F.raise_error(line))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Only the given columns, each computed once per row.

    A plain projection may be merged into the filters and projections above it, and its
    expressions are then evaluated again for every use. A generator is never merged.
    """
    row = F.struct(*(c.alias(name) for name, c in columns.items()))
    return df.select(F.inline(F.array(row)))


def cells_of_lines(lines: DataFrame, line: str, policy: str) -> DataFrame:
    """Rows ``(i, j, v)`` from lines ``i,j,v``.

    ``permissive``: any line that is not three numbers is skipped; indexes may be floats.
    ``skip_bad_shape``: lines without exactly three fields are skipped, anything else that
    is not ``int,int,number`` fails.
    ``strict``: every line must start with ``int,int,number``; further fields are ignored.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, got {policy!r}")
    fields = once(lines, p=F.split(line, ",", -1))
    if policy != "strict":
        fields = fields.where(F.size("p") == 3)
    first, second, third = (F.get("p", F.lit(n)) for n in range(3))
    if policy == "permissive":
        numbers = once(fields, i=to_number(first), j=to_number(second), v=to_number(third))
        cells = once(
            numbers, i=to_rounded_index(F.col("i")), j=to_rounded_index(F.col("j")), v=F.col("v")
        )
        return cells.where("i is not null and j is not null and v is not null")
    p = F.col("p")
    return once(
        fields, i=or_fail(to_whole_index(first), p), j=or_fail(to_whole_index(second), p),
        v=or_fail(to_number(third), p),
    )


def line_of_cell(i: Column, j: Column, v: Column) -> Column:
    return F.concat_ws(",", i.cast("string"), j.cast("string"), v.cast("string"))
