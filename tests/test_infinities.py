"""One result for numbers that are not finite, whatever the plan and its sizes."""

import itertools

import numpy as np
import pytest

import matrixq as mq
from matrixq.operators import thin
from matrixq.operators.blocks import block_product
from matrixq.operators.convert import to_dense_rows
from matrixq.sources.cells import from_entries
from tests.conftest import cells

INF, NAN = float("inf"), float("nan")
STRATEGIES = ["join", "broadcast", "copartition", "rows", "block", "auto"]
#: Rows of A and columns of B with infinities, stored zeros, NaN and absent cells.
LEFT = [(0, 0, INF), (0, 1, 1.0), (1, 0, -INF), (1, 2, 0.0), (2, 1, NAN), (3, 0, INF), (3, 2, INF),
        (4, 1, 2.0), (4, 2, 3.0), (5, 0, 1.0), (5, 1, -1.0)]
RIGHT = [(0, 0, 0.0), (0, 1, 2.0), (1, 0, 5.0), (1, 2, 1.0), (2, 2, -INF), (2, 3, 4.0), (0, 3, INF),
         (0, 4, 1.0), (1, 4, 1.0)]


def stored_product(left, right):
    """Sums over pairs of stored cells only."""
    out = {}
    for (i, k, x), (m, j, y) in itertools.product(left, right):
        if k == m:
            out[i, j] = out.get((i, j), 0.0) + x * y
    return out


def same(found, expected):
    assert set(found) == set(expected)
    for at, v in expected.items():
        assert found[at] == v or (np.isnan(found[at]) and np.isnan(v)), (at, found[at], v)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_products(spark, strategy):
    a, b = from_entries(spark, LEFT, 6, 3, "double"), from_entries(spark, RIGHT, 3, 5, "double")
    expected = stored_product(LEFT, RIGHT)
    same(cells(mq.matmul(a, b, strategy)), expected)
    kept = {at: v for at, v in expected.items() if v != 0}
    same(cells(mq.matmul(a, b, strategy, keep_zeros=False)), kept)


@pytest.mark.parametrize("block,group,layers", [(1, 1, 1), (2, 2, 1), (2, 1, 2), (8, 1, 1)])
def test_tiles(spark, block, group, layers):
    a, b = from_entries(spark, LEFT, 6, 3, "double"), from_entries(spark, RIGHT, 3, 5, "double")
    same(cells(block_product(a, b, block=block, group=group, layers=layers)), stored_product(LEFT, RIGHT))


@pytest.mark.parametrize("strategy", ["join", "broadcast", "block", "auto"])
def test_gram(spark, strategy):
    m = from_entries(spark, LEFT, 6, 3, "double")
    flipped = [(k, i, v) for i, k, v in LEFT]
    same(cells(mq.gram(m, strategy=strategy)), stored_product(flipped, LEFT))


@pytest.mark.parametrize("limit", [10**6, 1])
def test_dense_rows_on_both_sides_of_the_limit(spark, monkeypatch, limit):
    monkeypatch.setattr(thin, "DENSE_FACTOR_LIMIT", limit)
    rows = [(0, [1.0, INF]), (1, [NAN, 2.0]), (2, [0.0, 3.0]), (3, [-INF, INF])]
    diagonal = [(0, 0, 2.0), (1, 1, 3.0)]
    full = [(i, k, x) for i, v in rows for k, x in enumerate(v)]
    dense = spark.createDataFrame(rows, "i long, vals array<double>")
    for right, cols in ((diagonal, 2), ([(0, 0, INF), (1, 0, 0.0), (1, 2, 1.0)], 3)):
        b = from_entries(spark, right, 2, cols, "double")
        same(cells(mq.dense_rows_matmul(dense, b, n_rows=4)), stored_product(full, right))


def test_vanishing_products_stay(spark):
    """A product too small for a double is still a stored cell."""
    a = from_entries(spark, [(0, 0, 1e-200), (1, 0, 1.0)], 2, 1, "double")
    b = from_entries(spark, [(0, 0, 1e-200), (0, 1, 1.0)], 1, 2, "double")
    for strategy in STRATEGIES:
        assert cells(mq.matmul(a, b, strategy))[0, 0] == 0.0
    assert to_dense_rows(mq.matmul(a, b, "rows")).count() == 2
