"""Hot inner indexes are split, and the result stays whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import matrixq as mq
from matrixq.plans import skew
from matrixq.plans.stats import ProductStats
from matrixq.sources.cells import from_entries
from tests.conftest import cells, dense


@pytest.fixture
def low_floor(monkeypatch):
    monkeypatch.setattr(skew, "WORK_FLOOR", 20)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all cells of each factor share the inner index 3."""
    a = spark.range(60).selectExpr("id i", "3 j", "id % 5 + 1 v")
    a = a.unionAll(spark.range(120).selectExpr("id % 60 i", "4 + id div 6 j", "id % 7 - 3 v"))
    b = spark.range(50).selectExpr("3 i", "id j", "id % 3 - 1 v")
    b = b.unionAll(spark.range(100).selectExpr("4 + id div 6 i", "id % 50 j", "id % 4 v"))
    to_long = lambda d: d.select(*(F.col(c).cast("bigint").alias(c) for c in "ijv"))
    return mq.Matrix(to_long(a), 60, 30).persist(), mq.Matrix(to_long(b), 30, 50).persist()


@pytest.mark.parametrize("strategy", ["join", "copartition"])
def test_split_products(skewed, low_floor, strategy):
    a, b = skewed
    c = mq.matmul(a, b, strategy)
    assert "part_l" in c.cells._jdf.queryExecution().analyzed().toString()
    plain = mq.matmul(a, b, strategy, split_hot=False)
    assert cells(c) == cells(plain)
    assert np.array_equal(dense(c), dense(mq.coalesce_cells(a)) @ dense(mq.coalesce_cells(b)))


def test_split_gram(skewed, low_floor):
    a, b = (mq.coalesce_cells(m) for m in skewed)
    assert np.array_equal(dense(mq.gram(b, strategy="join")), dense(b).T @ dense(b))
    assert np.array_equal(dense(mq.gram(a, "rows", "join")), dense(a) @ dense(a).T)


def test_split_scaling_and_filter(skewed, low_floor):
    a, b = skewed
    a = mq.coalesce_cells(a)
    undeclared = mq.Matrix(b.T.cells)
    assert cells(mq.scale_columns(a, undeclared)) == cells(mq.scale_columns(a, b.T))
    rows = mq.Matrix(b.cells)
    assert cells(mq.keep_matching_columns(a, rows)) == cells(mq.keep_matching_columns(a, b))


def test_hot_key_of_one_side_only_is_dropped(spark, low_floor):
    a = mq.Matrix(spark.range(200).selectExpr("id i", "1L j", "1L v"), 200, 3, unique=True)
    b = from_entries(spark, [(0, 0, 1), (2, 0, 1)], 3, 1)
    assert mq.is_empty(mq.matmul(a, b, "join"))


def test_no_hot_key_leaves_the_plan_alone(skewed):
    a, b = skewed
    plan = mq.matmul(a, b, "join").cells._jdf.queryExecution().analyzed().toString()
    assert "part_l" not in plan


def test_pieces_of_a_hot_key_are_even(spark, low_floor):
    left = spark.range(1000).selectExpr("7L k", "id i")
    right = spark.range(10).selectExpr("7L k", "id j")
    sides = skew.Sides(left, right, "i", "j", unique=True)
    hot = sides.hot_keys(sides.stats())
    l, r, keys = skew.split_hot_keys(left, right, "i", "j", hot)
    pairs = l.join(r, keys)
    assert pairs.count() == 10_000 and pairs.select("i", "j").distinct().count() == 10_000
    stats = sides.stats()
    sizes = [row["count"] for row in pairs.groupBy(*keys).count().collect()]
    assert max(sizes) <= 3 * skew.work_limit(stats)


def test_grid_has_enough_pieces():
    for n, m, share in [(10**9, 1, 50), (1, 10**9, 50), (1000, 1000, 7), (5, 10**6, 12), (3, 3, 1)]:
        parts_l, parts_r = skew.grid_of(n, m, share)
        assert share <= parts_l * parts_r <= 2 * share + max(parts_l, parts_r)
    assert skew.grid_of(10, 0, 5) == (0, 0)


def test_limit_bounds_the_number_of_hot_keys():
    stats = ProductStats(0, 0, 0, work=1e15, top_work=1e12)
    assert stats.work / skew.work_limit(stats) <= skew.MAX_HOT


def test_copies_of_one_cell_do_not_make_a_key_hot(spark, low_floor):
    copies = spark.range(500).selectExpr("0L i", "1L j", "1L v")
    a = mq.Matrix(copies.unionAll(spark.range(40).selectExpr("id i", "2L j", "1L v")), 40, 3)
    b = from_entries(spark, [(k, j, 1) for k in (1, 2) for j in range(3)], 3, 3)
    sides = skew.Sides(
        a.cells.withColumnRenamed("j", "k"), b.cells.withColumnRenamed("i", "k"), "i", "j", False
    )
    skew_limit = skew.work_limit(sides.stats())
    assert [h.k for h in sides.hot_keys(sides.stats())] == [2] and 500 * 3 > skew_limit
    assert np.array_equal(
        dense(mq.matmul(a, b, "join")), dense(mq.coalesce_cells(a)) @ dense(b)
    )


def test_tasks_follow_the_products(spark, monkeypatch):
    from matrixq.plans import stats
    from matrixq.sources.cells import generate

    assert ProductStats(10**6, 10**6, 10**6, 0.0, 0.0).tasks() is None
    assert ProductStats(10**6, 10**6, 10**8, 0.0, 0.0).tasks() == 50
    assert ProductStats(10**12, 10**12, 10**16, 0.0, 0.0).tasks() == 32_768
    monkeypatch.setattr(stats, "PRODUCTS_PER_TASK", 1000)
    a, b = generate(spark, 40, 30, 0.5, 1), generate(spark, 30, 40, 0.5, 2)
    expected = dense(a) @ dense(b)
    for strategy in ("join", "auto"):
        c = mq.matmul(a, b, strategy)
        plan = c.cells._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_NUM" in plan
        assert np.array_equal(dense(c), expected)
    for strategy in ("join", "broadcast"):
        assert np.array_equal(dense(mq.gram(a, strategy=strategy)), dense(a).T @ dense(a))


@pytest.mark.parametrize("slack", [4, 0])
def test_output_lines_stay_in_one_task_unless_one_is_too_long(spark, monkeypatch, slack):
    from matrixq.operators.product import _broadcast_product, raw_sides
    from matrixq.plans import stats
    from matrixq.sources.cells import generate

    monkeypatch.setattr(stats, "PRODUCTS_PER_TASK", 1000)
    monkeypatch.setattr(skew, "PRODUCTS_PER_TASK", 1000)
    monkeypatch.setattr(skew, "LINE_SLACK", slack)
    a, b = generate(spark, 40, 30, 0.5, 1), generate(spark, 30, 40, 0.5, 2)
    known = raw_sides(a, b).stats()
    for small in ("left", "right"):
        c = _broadcast_product(a, b, small, known)
        plan = c.cells._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == (1 if slack else 2)
        assert np.array_equal(dense(c), dense(a) @ dense(b))
