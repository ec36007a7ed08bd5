"""Every strategy against hand-computed products, numpy, and each other."""

import numpy as np
import pytest

import matrixq as mq
from matrixq.sources.cells import empty, from_entries, generate, identity
from tests.conftest import cells, dense

CELL_PLANS = ["join", "broadcast", "copartition", "rows"]
ALL_PLANS = [*CELL_PLANS, "block", "auto"]


def full(spark, rows):
    entries = [(i, j, v) for i, row in enumerate(rows) for j, v in enumerate(row) if v]
    return from_entries(spark, entries, len(rows), len(rows[0]))


@pytest.fixture(scope="module")
def pair(spark):
    return generate(spark, 40, 30, 0.3, seed=1).persist(), generate(spark, 30, 20, 0.2, 2).persist()


@pytest.mark.parametrize("strategy", ALL_PLANS)
def test_product_is_not_column_scaling(spark, strategy):
    a, b = full(spark, [[1, 2], [0, 3]]), full(spark, [[4, 5], [6, 7]])
    c = mq.matmul(a, b, strategy)
    assert cells(c) == {(0, 0): 16, (0, 1): 19, (1, 0): 18, (1, 1): 21}
    assert c.shape == (2, 2)


@pytest.mark.parametrize("strategy", ALL_PLANS)
def test_duplicates_add_up_and_cancelled_cells(spark, strategy):
    a = from_entries(spark, [(0, 0, 1), (0, 1, 1), (1, 0, 2), (1, 0, 3), (1, 1, 0)], 2, 2)
    b = from_entries(spark, [(0, 0, 1), (1, 0, -1), (1, 1, 4)], 2, 2)
    c = mq.matmul(a, b, strategy)
    kept = {(0, 0): 0, (0, 1): 4, (1, 0): 5, (1, 1): 0}
    dropped = {(0, 1): 4, (1, 0): 5}
    assert cells(c) == kept
    assert cells(mq.drop_zeros(c)) == dropped
    assert cells(mq.matmul(a, b, strategy, keep_zeros=False)) == dropped


@pytest.mark.parametrize("block, layers", [(1, 1), (1, 2), (2, 1)])
def test_cancelled_cells_over_tiles_and_layers(spark, block, layers):
    from matrixq.operators.blocks import block_product

    a = from_entries(spark, [(0, 0, 1), (0, 1, 1), (2, 1, 0)], 3, 2)
    b = from_entries(spark, [(0, 0, 1), (1, 0, -1), (1, 1, 4)], 2, 2)
    c = block_product(a, b, block=block, layers=layers)
    assert cells(c) == {(0, 0): 0, (0, 1): 4, (2, 0): 0, (2, 1): 0}
    gram = mq.gram(from_entries(spark, [(0, 0, 1), (0, 1, 1), (1, 0, 1), (1, 1, -1)], 2, 2), strategy="block", block=block)
    assert cells(gram) == {(0, 0): 2, (0, 1): 0, (1, 0): 0, (1, 1): 2}


@pytest.mark.parametrize("strategy", ALL_PLANS)
def test_cell_outside_of_the_shape_is_an_error(spark, strategy):
    outside = mq.Matrix(spark.createDataFrame([(0, 5, 1)], "i long, j long, v long"), 1, 2)
    other = from_entries(spark, [(0, 0, 1), (1, 0, 1)], 2, 1)
    with pytest.raises(Exception, match="outside of the shape"):
        mq.nnz(mq.matmul(outside, other, strategy)).collect()


def test_inferred_inner_sizes_are_warned_about(spark):
    a = mq.infer_dims(mq.Matrix(from_entries(spark, [(0, 0, 1), (1, 1, 2)], 2, 3).cells))
    b = mq.infer_dims(mq.Matrix(from_entries(spark, [(0, 0, 5), (2, 0, 7)], 3, 1).cells))
    for strategy in ALL_PLANS:
        with pytest.warns(UserWarning, match="inferred"):
            assert cells(mq.matmul(a, b, strategy)) == {(0, 0): 5}
    with pytest.raises(ValueError, match="inner sizes differ"):
        mq.matmul(a, from_entries(spark, [(0, 0, 1)], 1, 1))


def test_index_range(spark):
    m = from_entries(spark, [(3, 1, 1), (7, 4, 1)], 9, 9)
    assert tuple(mq.index_range(m).first()) == (3, 7, 1, 4)
    assert tuple(mq.index_range(empty(spark, 2, 2)).first()) == (None,) * 4


@pytest.mark.parametrize("strategy", ["join", "copartition"])
def test_work_floor_splits_and_changes_nothing(pair, strategy):
    a, b = pair
    found = mq.matmul(a, b, strategy, work_floor=3)
    assert np.array_equal(dense(found), dense(a) @ dense(b))
    assert cells(mq.gram(a, strategy="join", work_floor=3)) == cells(mq.gram(a, strategy="join"))


@pytest.mark.parametrize("strategy", ALL_PLANS)
def test_empty_last_column_is_not_refused(spark, strategy):
    a = from_entries(spark, [(0, 0, 1), (1, 1, 2)], 2, 3)
    b = from_entries(spark, [(0, 0, 5), (2, 0, 7)], 3, 1)
    c = mq.matmul(a, b, strategy)
    assert cells(c) == {(0, 0): 5}
    assert c.shape == (2, 1)


@pytest.mark.parametrize("strategy", ALL_PLANS)
def test_empty_inputs_give_an_empty_product(spark, strategy):
    for inner in (0, 3):
        c = mq.matmul(empty(spark, 2, inner), empty(spark, inner, 2), strategy)
        assert mq.is_empty(c) and c.shape == (2, 2)


@pytest.mark.parametrize("strategy", ALL_PLANS)
def test_inner_mismatch_is_an_error(spark, strategy):
    with pytest.raises(ValueError, match="inner sizes differ"):
        mq.matmul(empty(spark, 2, 2), empty(spark, 3, 2), strategy)


def test_unknown_strategy_is_an_error(spark):
    with pytest.raises(ValueError, match="strategy"):
        mq.matmul(empty(spark, 2, 2), empty(spark, 2, 2), "fast")


@pytest.mark.parametrize("strategy", ALL_PLANS)
def test_strategies_agree_with_numpy(pair, strategy):
    a, b = pair
    assert np.array_equal(dense(mq.matmul(a, b, strategy)), dense(a) @ dense(b))


@pytest.mark.parametrize("strategy", ALL_PLANS)
def test_undeclared_shapes(pair, strategy):
    a, b = pair
    c = mq.matmul(mq.Matrix(a.cells), mq.Matrix(b.cells), strategy)
    assert cells(mq.drop_zeros(c)) == cells(mq.drop_zeros(mq.matmul(a, b, "join")))


@pytest.mark.parametrize("strategy", ALL_PLANS)
def test_double_values(spark, strategy):
    a = generate(spark, 20, 15, 0.4, 3, "double")
    b = generate(spark, 15, 10, 0.4, 4, "double")
    a = a.with_cells(a.cells.selectExpr("i", "j", "v / 7 as v"))
    assert np.allclose(dense(mq.matmul(a, b, strategy)), dense(a) @ dense(b))


@pytest.mark.parametrize("block,layers", [(7, None), (7, 1), (7, 3), (64, 1), (1, 2)])
def test_block_edges_and_layers(pair, block, layers):
    from matrixq.operators.blocks import block_product

    a, b = pair
    c = block_product(a, b, block=block, layers=layers)
    assert np.array_equal(dense(c), dense(a) @ dense(b))


def test_block_does_not_mix_infinities_with_absent_cells(spark):
    a = from_entries(spark, [(0, 0, float("inf")), (1, 1, 2.0)], 2, 2, "double")
    b = from_entries(spark, [(0, 0, 1.0), (1, 1, float("nan"))], 2, 2, "double")
    for strategy in ("join", "block"):
        found = cells(mq.matmul(a, b, strategy))
        assert found[(0, 0)] == float("inf") and np.isnan(found[(1, 1)]) and len(found) == 2


def test_block_is_exact_beyond_doubles_and_fails_on_overflow(spark):
    big = 2**40 + 1
    a = from_entries(spark, [(0, 0, big), (0, 1, 3)], 1, 2)
    b = from_entries(spark, [(0, 0, 2**20 + 1), (1, 0, 5)], 2, 1)
    assert cells(mq.matmul(a, b, "block")) == {(0, 0): big * (2**20 + 1) + 15}
    wide = from_entries(spark, [(0, 0, 3 * 2**61)], 1, 1)
    for strategy in ("join", "block"):
        assert cells(mq.matmul(wide, from_entries(spark, [(0, 0, 1)], 1, 1), strategy)) == {(0, 0): 3 * 2**61}
    huge = from_entries(spark, [(0, 0, 2**62), (1, 0, 2**62)], 2, 1)
    with pytest.raises(Exception, match="64-bit"):
        mq.matmul(huge, from_entries(spark, [(0, 0, 4)], 1, 1), "block").cells.collect()


def test_identity_transpose_and_associativity(spark, pair):
    a, b = pair
    assert cells(mq.matmul(a, identity(spark, 30))) == cells(a)
    assert cells((a @ b).T) == cells(b.T @ a.T)
    x = generate(spark, 20, 1, 1.0, 5)
    left = mq.matvec(a @ b, x)
    assert np.array_equal(dense(left), dense(mq.matvec(a, mq.matvec(b, x))))


def test_vectors(spark, pair):
    a, _ = pair
    x, y = generate(spark, 30, 1, 0.9, 6), generate(spark, 1, 40, 0.9, 7)
    assert np.array_equal(dense(mq.matvec(a, x)), dense(a) @ dense(x))
    assert np.array_equal(dense(mq.vecmat(y, a)), dense(y) @ dense(a))
    with pytest.raises(ValueError):
        mq.matvec(a, y)
    with pytest.raises(ValueError):
        mq.vecmat(x, a)
    # A vector too large to broadcast goes through the shuffle join.
    assert np.array_equal(dense(mq.matvec(a, x, broadcast_limit=0)), dense(a) @ dense(x))


@pytest.mark.parametrize("of", ["columns", "rows"])
@pytest.mark.parametrize("strategy", ["auto", "join", "broadcast", "block"])
def test_gram(pair, of, strategy):
    a, _ = pair
    x = dense(a)
    expected = x.T @ x if of == "columns" else x @ x.T
    assert np.array_equal(dense(mq.gram(a, of, strategy, block=8)), expected)


def test_gram_of_duplicates(spark):
    m = from_entries(spark, [(0, 0, 1), (0, 0, 2), (0, 1, 5)], 1, 2)
    assert cells(mq.gram(m)) == {(0, 0): 9, (0, 1): 15, (1, 0): 15, (1, 1): 25}


def test_sum_of_product(pair, spark):
    a, b = pair
    assert mq.sum_of_product(a, b).first()["total"] == (dense(a) @ dense(b)).sum()
    assert mq.sum_of_product(empty(spark, 2, 3), empty(spark, 3, 2)).first()["total"] == 0
    assert mq.total(mq.matmul(a, b)).first()["total"] == (dense(a) @ dense(b)).sum()


def test_copartition_serves_several_products(pair):
    a, b = pair
    prepared = mq.copartition(a, b, 5).persist()
    expected = dense(a) @ dense(b)
    for _ in range(2):
        assert np.array_equal(dense(mq.multiply_prepared(prepared)), expected)
    prepared.unpersist()


def test_dense_rows_times_thin(spark, pair):
    a, b = pair
    rows = mq.to_dense_rows(a, all_rows=True)
    c = mq.dense_rows_matmul(rows, b, n_rows=40)
    assert np.array_equal(dense(c), dense(a) @ dense(b))
    # Without a declared shape the factor is not known to be small; the result is the same.
    undeclared = mq.dense_rows_matmul(rows, mq.Matrix(b.cells), n_rows=40)
    assert cells(undeclared) == cells(c)
    assert undeclared.value_type == c.value_type


def test_dense_rows_are_checked_and_exact(spark):
    rows = spark.createDataFrame([(0, [1, 2]), (1, [3, 4, 5, 6])], "i long, vals array<long>")
    thin = from_entries(spark, [(0, 0, 1), (1, 0, 10), (2, 0, 100)], 3, 1)
    for factor in (thin, mq.Matrix(thin.cells, 3)):
        with pytest.raises(Exception, match="expected 3 values in row"):
            mq.nnz(mq.dense_rows_matmul(rows, factor)).collect()
    big = spark.createDataFrame([(0, [2**53 + 1])], "i long, vals array<long>")
    one = from_entries(spark, [(0, 0, 1)], 1, 2)
    assert cells(mq.dense_rows_matmul(big, one)) == {(0, 0): 2**53 + 1}
    assert cells(mq.dense_rows_matmul(big, empty(spark, 1, 0))) == {}


def test_duplicate_error_cannot_be_pruned(spark):
    m = mq.Matrix(spark.createDataFrame([(0, 0, 1), (0, 0, 2)], "i long, j long, v long"), 1, 1)
    checked = mq.coalesce_cells(m, "error")
    for read in (mq.nnz, mq.info, mq.distinct_indexes):
        with pytest.raises(Exception, match="duplicate cell"):
            read(checked).collect()
    with pytest.raises(Exception, match="duplicate cell"):
        checked.cells.count()


def test_scale_columns(spark):
    a, b = full(spark, [[1, 2], [0, 3]]), full(spark, [[4, 5], [6, 7]])
    assert cells(mq.scale_columns(a, b)) == {(0, 0): 10, (0, 1): 24, (1, 1): 36}
    undeclared = mq.scale_columns(a, mq.Matrix(b.cells))
    assert cells(undeclared) == {(0, 0): 10, (0, 1): 24, (1, 1): 36}


def test_agrees_with_the_library_block_matrix(spark, pair):
    from pyspark.mllib.linalg.distributed import CoordinateMatrix, MatrixEntry

    blocked = []
    for m in pair:
        entries = spark.sparkContext.parallelize(
            [MatrixEntry(i, j, float(v)) for (i, j), v in cells(m).items()], 2
        )
        blocked.append(CoordinateMatrix(entries, *m.shape).toBlockMatrix(16, 16))
    expected = blocked[0].multiply(blocked[1]).toLocalMatrix().toArray()
    for strategy in ALL_PLANS:
        assert np.array_equal(dense(mq.matmul(*pair, strategy)), expected)


@pytest.mark.parametrize("strategy", ALL_PLANS)
def test_small_whole_types_are_widened(spark, strategy):
    a = from_entries(spark, [(0, 0, 2**30)], 1, 1, "int")
    c = mq.matmul(a, from_entries(spark, [(0, 0, 2**20)], 1, 1, "int"), strategy)
    assert cells(c) == {(0, 0): 2**50}
    assert cells(mq.gram(a)) == {(0, 0): 2**60}
    assert mq.sum_of_product(a, a).first()["total"] == 2**60


def test_copartition_count_follows_the_data(pair, monkeypatch):
    from matrixq.operators import product

    assert mq.copartition(*pair).num_partitions == 64
    assert mq.copartition(*pair, split_hot=False).num_partitions == 64
    assert mq.copartition(*pair, 7).num_partitions == 7
    monkeypatch.setattr(product, "CELLS_PER_TASK", 4)
    assert mq.copartition(*pair).num_partitions == 120


def test_what_auto_takes(spark, pair):
    from matrixq.operators.product import pick_strategy

    a, b = pair
    assert pick_strategy(a, b)[0] == "broadcast"
    assert pick_strategy(a, b, broadcast_limit=0)[0] == "join"
    wide = generate(spark, 600, 600, 1.0, 9)
    assert pick_strategy(wide, wide, broadcast_limit=0)[0] == "block"
