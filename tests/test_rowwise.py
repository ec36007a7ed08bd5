"""The row-wise product, its estimate of the result's size, and the tiles' pieces."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import matrixq as mq
from matrixq.bench.workloads import ALL
from matrixq.functions.cell_products import ByInner, Sums
from matrixq.operators import blocks, rowwise
from matrixq.operators.blocks import block_product
from matrixq.operators.product import matmul
from matrixq.operators.rowwise import row_product
from matrixq.plans.limits import PART_CELLS, PART_PRODUCTS, PART_SUMS, number_of_parts
from matrixq.plans.stats import RowWork, row_work
from matrixq.sources.cells import empty, from_entries, generate
from tests.conftest import cells, dense
from tests.test_plans import plan_of


@pytest.fixture(scope="module")
def pair(spark):
    return generate(spark, 60, 50, 0.2, 1).persist(), generate(spark, 50, 40, 0.2, 2).persist()


def test_no_sum_is_shuffled(pair):
    plan = plan_of(row_product(*pair).cells)
    assert "HashAggregate" not in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange") == 1 and plan.count("MapInArrow") == 3


def test_rows_of_b_go_to_the_parts_that_name_them(spark):
    """Far more inner indexes than cells: nothing is sent to parts that do not need it."""
    a = from_entries(spark, [(i, 1000 * i, i + 1) for i in range(30)], 30, 30_000)
    b = from_entries(spark, [(1000 * k, k % 7, k) for k in range(30)], 30_000, 7)
    c = row_product(a, b, part_products=3)
    assert "BroadcastHashJoin" in plan_of(c.cells)
    assert cells(c) == {(i, i % 7): (i + 1) * i for i in range(30)} == cells(matmul(a, b, "join"))


@pytest.mark.parametrize("part_products", [1, 50, 10**6])
def test_long_rows_are_split_by_columns(spark, pair, part_products):
    a, b = pair
    long = from_entries(spark, [(7, k, k + 1) for k in range(50)] + [(0, 3, 1)], 60, 50)
    c = row_product(long, b, part_products=part_products)
    assert np.array_equal(dense(c), dense(long) @ dense(b))
    assert len(cells(c)) == len(cells(matmul(long, b, "join")))


def test_many_buckets_and_merged_sums(spark, pair, monkeypatch):
    a, b = pair
    monkeypatch.setattr(rowwise, "PART_CELLS", 20)
    c = row_product(a, b, part_products=100)
    assert np.array_equal(dense(c), dense(a) @ dense(b))


def test_odd_factors(spark):
    assert cells(row_product(empty(spark, 3, 4), empty(spark, 4, 2))) == {}
    a = from_entries(spark, [(0, 0, 2), (0, 0, 3), (1, 1, 4)], 2, 2)
    b = from_entries(spark, [(0, 0, 1), (0, 0, 1), (1, 0, 7)], 2, 1)
    assert cells(row_product(a, b)) == {(0, 0): 10, (1, 0): 28}
    wide = 1 << 40
    a = from_entries(spark, [(wide - 1, 0, 2)], wide, 1)
    b = from_entries(spark, [(0, wide - 1, 3)], 1, wide)
    assert cells(row_product(a, b)) == {(wide - 1, wide - 1): 6}


def test_whole_numbers_are_exact_or_an_error(spark):
    big = 2**40 + 1
    a = from_entries(spark, [(0, 0, big), (0, 1, 3)], 1, 2)
    b = from_entries(spark, [(0, 0, 2**20 + 1), (1, 0, 5)], 2, 1)
    assert cells(row_product(a, b)) == {(0, 0): big * (2**20 + 1) + 15}
    a = from_entries(spark, [(0, 0, 2**62), (0, 1, 2**62), (0, 2, -(2**62))], 1, 3)
    b = from_entries(spark, [(0, 0, 1), (1, 0, 1), (2, 0, 1)], 3, 1)
    assert cells(row_product(a, b)) == {(0, 0): 2**62}  # passes 64 bits on the way
    with pytest.raises(Exception, match="64-bit"):
        row_product(a, from_entries(spark, [(0, 0, 4)], 3, 1)).cells.collect()


@pytest.mark.parametrize("whole", [True, False])
def test_sums_in_an_array_and_in_runs(whole, monkeypatch):
    from matrixq.functions import cell_products

    monkeypatch.setattr(cell_products, "AT_A_TIME", 7)
    random = np.random.default_rng(3)
    line, k, v = random.integers(0, 5, 40), random.integers(0, 6, 40), random.integers(-9, 9, 40)
    j, m, w = random.integers(0, 4, 30), random.integers(0, 6, 30), random.integers(-9, 9, 30)
    kind = np.int64 if whole else np.float64
    expected = {}
    for a, b, x in zip(line, k, v):
        for c, d, y in zip(j, m, w):
            if b == d:
                expected[a * 4 + c] = expected.get(a * 4 + c, 0) + x * y
    for size in (100, 0):
        sums = Sums(20, whole, size)
        for row, col, x, y in ByInner(line, k, v.astype(kind)).products(m, j, w.astype(kind)):
            sums.add(row * 4 + col, x, y)
        keys, values = sums.result()
        assert dict(zip(keys.tolist(), values.tolist())) == expected


@pytest.mark.parametrize("workload", ALL, ids=lambda w: w.name)
def test_estimated_size_of_the_result(spark, workload):
    """Within a tenth for all families, scaled down where they are large."""
    small = lambda n: min(n, 600) if n > 1 else 1
    density = max(workload.density, 0.005)
    a = generate(spark, small(workload.n_rows), small(workload.n_inner), density, 1)
    b = generate(spark, small(workload.n_inner), small(workload.n_cols), density, 2)
    exact = matmul(a, b, "broadcast").cells.count()
    work = row_work(a, b)
    assert abs(work.sums - exact) <= 0.1 * exact
    assert work.products == a.cells.withColumnRenamed("j", "k").drop("v").join(
        b.cells.select(F.col("i").alias("k"), "j"), "k").count()


def test_estimate_of_a_band(spark):
    """Few output cells for many products: neither the products nor the area tell."""
    band = from_entries(spark, [(i, i + d, 1) for i in range(500) for d in range(10) if i + d < 500], 500, 500)
    exact = matmul(band, band, "broadcast").cells.count()
    assert abs(row_work(band, band).sums - exact) <= 0.1 * exact


def test_parts_follow_the_estimate():
    assert number_of_parts(10**9, 10**9, 10**6, 8) == -(-10**9 // PART_SUMS)
    assert number_of_parts(10**9, 10**4, 10**6, 8) == -(-10**9 // PART_PRODUCTS)
    assert number_of_parts(10**7, 10**4, 10**9, 8) == -(-10**9 // PART_CELLS)
    assert number_of_parts(0, 0, 0, 8) == 1
    assert number_of_parts(10**15, 10**14, 0, 8) == 32_768


def test_plan_has_the_parts_asked_for(spark, pair):
    work = RowWork(10**6, 10, 600, 9 * PART_SUMS, 60, 50, 40)
    assert "RepartitionByExpression" in row_product(*pair, work=work).cells._jdf.queryExecution().optimizedPlan().toString()
    assert ", 9" in [x for x in plan_of(row_product(*pair, work=work).cells).split("\n") if "Exchange" in x][0]


# Pieces of tiles


def test_symmetric_plan_sends_half(spark):
    """The groups on the diagonal get one copy, those below it none."""
    m = generate(spark, 40, 60, 0.3, 1).persist()
    half = block_product(m.T, m, block=10, group=1, symmetric=True)
    whole = block_product(m.T, m, block=10, group=1)
    assert cells(half) == cells(whole)

    def sent(c):
        plan = c.cells._jdf.queryExecution().toString()
        return plan

    assert "gi" in sent(half)
    down = 6
    copies = lambda symmetric: down * (down - 1) // 2 * 2 + down if symmetric else 2 * down * down
    assert copies(True) <= 0.6 * copies(False)


def test_many_groups_and_an_unbroadcast_list(spark, monkeypatch):
    a, b = generate(spark, 50, 8, 0.3, 1), generate(spark, 8, 50, 0.3, 2)
    expected = cells(matmul(a, b, "join"))
    assert cells(block_product(a, b, block=5, group=1)) == expected
    monkeypatch.setattr(blocks, "fits_broadcast", lambda *_: False)
    c = block_product(a, b, block=8, group=1, layers=1)  # one inner tile
    assert cells(c) == expected
    monkeypatch.setattr(blocks, "SENT_TO_ALL", 1)
    c = block_product(a, b, block=8, group=1, layers=1)
    assert cells(c) == expected and "spread" in plan_of(c.cells)
