"""Splitting hot join keys.

A product joins the columns of ``A`` with the rows of ``B`` on the inner index ``k``. If one
``k`` holds a large share of the cells, a plain shuffle join puts it all into one task. Here
such a key is cut into a grid: the left cells into ``parts_l`` groups, the right cells into
``parts_r``, and each pair of groups becomes a join key of its own. Every pair of cells still
meets exactly once, so the result is unchanged.

A key is hot when its work exceeds both a floor and one ``MAX_HOT``-th of all work. At most
``MAX_HOT`` keys can do so, whatever the data, and that bounds the table that is broadcast.

Work is counted on cells as they come, which costs no shuffle of the cells. Duplicates make a
key look larger than it is once they are summed, so only the keys found hot are counted again
without duplicates.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matrixq.plans.limits import PRODUCTS_PER_TASK
from matrixq.plans.stats import ProductStats, collect_stats, key_work

MAX_HOT = 20_000
# Cell pairs one task may form for a single key before that key is worth cutting.
WORK_FLOOR = PRODUCTS_PER_TASK

# One output line may bring a task this many times the products it should form.
LINE_SLACK = 4

PART_KEYS = ["k", "part_l", "part_r"]


@dataclass(frozen=True)
class HotKey:
    """``share``: the number of tasks the key deserves."""

    k: int
    n_left: int
    n_right: int
    share: int


def work_limit(stats: ProductStats, floor: int | None = None) -> float:
    return max(float(WORK_FLOOR if floor is None else floor), stats.work / MAX_HOT)


@dataclass(frozen=True)
class Sides:
    """Two factors as they come, ``left`` with columns ``k`` and ``left_index``, ``right`` with
    ``k`` and ``right_index``; ``unique`` if neither can hold a pair of these twice."""

    left: DataFrame
    right: DataFrame
    left_index: str
    right_index: str
    unique: bool

    def stats(self) -> ProductStats:
        """Runs one aggregation job; counts duplicates."""
        return collect_stats(self._work(self.left, self.right))

    def _work(self, left: DataFrame, right: DataFrame) -> DataFrame:
        return key_work(left, right, self.left_index, self.right_index)

    def hot_keys(self, stats: ProductStats, floor: int | None = None) -> list[HotKey]:
        """At most ``MAX_HOT`` keys. Runs jobs only if a key looks hot."""
        limit = work_limit(stats, floor)
        if stats.top_work <= limit:
            return []
        work = self._work(self.left, self.right).where(F.col("work") > limit)
        if not self.unique:
            spark = self.left.sparkSession
            keys = spark.createDataFrame([(row["k"],) for row in work.collect()], "k bigint")
            work = self._work(
                _distinct_of(self.left, self.left_index, keys),
                _distinct_of(self.right, self.right_index, keys),
            ).where(F.col("work") > limit)
        found = work.select("k", "n_left", "n_right", "work").collect()
        return [HotKey(k, n, m, math.ceil(w / limit)) for k, n, m, w in found]


def _distinct_of(side: DataFrame, index: str, keys: DataFrame) -> DataFrame:
    return side.join(F.broadcast(keys), "k", "left_semi").select("k", index).distinct()


def grid_of(n_left: int, n_right: int, share: int) -> tuple[int, int]:
    """``(parts_l, parts_r)`` with at least ``share`` pairs of groups and the least copying;
    no parts for a key that only one side has."""
    if n_left == 0 or n_right == 0:
        return 0, 0
    parts_l = min(share, math.ceil(math.sqrt(share * n_left / n_right)))
    return parts_l, math.ceil(share / parts_l)


def split_hot_keys(left: DataFrame, right: DataFrame, left_index: str, right_index: str,
                   hot: list[HotKey]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with hot keys split, and the columns to join them on. Without a hot key both
    stay as they are."""
    if not hot:
        return left, right, ["k"]
    rows = [(h.k, *grid_of(h.n_left, h.n_right, h.share)) for h in hot]
    grid = F.broadcast(
        left.sparkSession.createDataFrame(rows, "k bigint, parts_l bigint, parts_r bigint")
    )
    wanted = F.expr("parts_l is null or parts_l > 0")
    left = left.join(grid, "k", "left").where(wanted).select(
        *left.columns,
        _own_part(left_index, F.col("parts_l")).alias("part_l"),
        _each_from(0, F.col("parts_r")).alias("part_r"),
    )
    right = right.join(grid, "k", "left").where(wanted).select(
        *right.columns,
        _own_part(right_index, F.col("parts_r")).alias("part_r"),
        _each_from(0, F.col("parts_l")).alias("part_l"),
    )
    return left, right, PART_KEYS


def split_hot_keys_upper(left: DataFrame, right: DataFrame, left_index: str, right_index: str,
                         hot: list[HotKey]) -> tuple[DataFrame, DataFrame, list[str]]:
    """The same for a matrix with itself, keeping only the groups ``part_l <= part_r``.

    Cell pairs of two different groups then meet in one order only; within one group both
    orders meet and the caller keeps one.
    """
    if not hot:
        return left, right, ["k"]
    rows = [(h.k, math.ceil(math.sqrt(h.share))) for h in hot]
    grid = F.broadcast(left.sparkSession.createDataFrame(rows, "k bigint, parts bigint"))
    parts = F.col("parts")
    left = left.join(grid, "k", "left").withColumn("part_l", _own_part(left_index, parts))
    right = right.join(grid, "k", "left").withColumn("part_r", _own_part(right_index, parts))
    left = left.withColumn("part_r", _each_from(F.col("part_l"), parts)).drop("parts")
    right = right.withColumn("part_l", _each_from(0, F.col("part_r") + 1)).drop("parts")
    return left, right, PART_KEYS


def deal_out(left: DataFrame, right: DataFrame, keys: list[str], stats: ProductStats):
    """Both sides in as many tasks as the products of their join need."""
    tasks = stats.tasks()
    if tasks is None:
        return left, right
    return left.repartition(tasks, *keys), right.repartition(tasks, *keys)


def deal_out_lines(cells: DataFrame, line: str, other: str, nnz: int,
                   stats: ProductStats) -> DataFrame:
    """Cells in as many tasks as their products need, each output line in one task.

    Counts the longest line; if that is too much for a task, cells are dealt out one by one.
    """
    tasks = stats.tasks()
    if tasks is None:
        return cells
    longest = cells.groupBy(line).count().agg(F.max("count")).first()[0]
    even = longest * stats.products / nnz <= LINE_SLACK * PRODUCTS_PER_TASK
    return cells.repartition(tasks, line) if even else cells.repartition(tasks, line, other)


def _own_part(index: str, parts: Column) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.when(parts.isNull(), zero).otherwise(F.pmod(F.xxhash64(index), parts))


def _each_from(first: Column | int, parts: Column) -> Column:
    first = F.lit(first).cast("bigint") if isinstance(first, int) else first
    return F.explode(F.sequence(first, F.coalesce(parts, F.lit(1)) - 1))
