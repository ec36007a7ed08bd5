"""Cell operators, aggregates, forms and looks."""

import numpy as np
import pytest

import matrixq as mq
from matrixq.plans import limits
from matrixq.sources.cells import empty, from_entries, generate
from tests.conftest import cells, dense


@pytest.fixture(scope="module")
def m(spark):
    return generate(spark, 23, 17, 0.4, seed=9).persist()


def test_transpose(m):
    assert np.array_equal(dense(m.T), dense(m).T)
    assert m.T.shape == (17, 23)


def test_duplicate_rules(spark):
    rows = spark.createDataFrame([(0, 0, 5, 1), (0, 0, 7, 2), (1, 0, 3, 1)], "i long,j long,v long,t int")
    twice = mq.Matrix(rows)
    assert cells(mq.coalesce_cells(twice)) == {(0, 0): 12, (1, 0): 3}
    assert cells(mq.coalesce_cells(twice, "last", ("t",))) == {(0, 0): 7, (1, 0): 3}
    with pytest.raises(Exception, match="duplicate cell 0 0"):
        mq.coalesce_cells(twice, "error").cells.collect()
    single = mq.Matrix(rows.where("t = 1"))
    assert cells(mq.coalesce_cells(single, "error")) == {(0, 0): 5, (1, 0): 3}
    with pytest.raises(ValueError):
        mq.coalesce_cells(twice, "last")
    with pytest.raises(ValueError):
        mq.coalesce_cells(twice, "first")


def test_info_and_dims(spark, m):
    row = mq.info(m).first()
    assert (row["n_rows"], row["n_cols"], row["nnz"]) == (23, 17, round(0.4 * 23 * 17))
    assert row["density"] == pytest.approx(row["nnz"] / (23 * 17))
    sparse = from_entries(spark, [(0, 0, 1), (4, 2, 1), (4, 2, 1)])
    row = mq.info(sparse).first()
    assert (row["n_rows"], row["n_cols"], row["nnz"]) == (5, 3, 2)
    assert mq.infer_dims(sparse).shape == (5, 3)
    half = from_entries(spark, [(0, 0, 1)], 7, None)
    assert mq.infer_dims(half).shape == (7, 1)
    nothing = mq.info(mq.Matrix(empty(spark, 0, 0).cells)).first()
    assert (nothing["n_rows"], nothing["nnz"], nothing["density"]) == (0, 0, None)


def test_sums_and_counts(m):
    x = dense(m)
    assert np.array_equal(dense(mq.row_sums(m)).ravel(), x.sum(axis=1))
    assert np.array_equal(dense(mq.column_sums(m)).ravel(), x.sum(axis=0))
    assert mq.total(m).first()["total"] == x.sum()
    assert mq.nnz(m).first()["nnz"] == np.count_nonzero(x)
    used = {r["j"] for r in mq.distinct_indexes(m, "j").collect()}
    assert used == set(np.flatnonzero(x.any(axis=0)))


def test_column_map_is_cut_into_chunks(m):
    rows = mq.column_map(m, chunk=5).collect()
    assert all(len(r["entries"]) <= 5 for r in rows)
    found = {(i, r["j"]): v for r in rows for i, v in r["entries"].items()}
    assert found == cells(m)


def test_keep_matching_columns(spark, m):
    b = from_entries(spark, [(2, 0, 1), (5, 3, 1), (5, 1, 1)], 17, 4)
    expected = {k: v for k, v in cells(m).items() if k[1] in (2, 5)}
    assert cells(mq.keep_matching_columns(m, b)) == expected


def test_blocks(m):
    rows = mq.to_blocks(m, 8).collect()
    x = dense(m)
    for r in rows:
        part = x[r["bi"] * 8 : r["bi"] * 8 + 8, r["bj"] * 8 : r["bj"] * 8 + 8]
        assert part.shape == (r["n_rows"], r["n_cols"])
        assert np.array_equal(np.array(r["data"]).reshape(part.shape), part)
    back = mq.from_blocks(mq.to_blocks(m, 8), 23, 17, 8)
    assert cells(back) == cells(m)
    with pytest.raises(ValueError):
        mq.to_blocks(m, 4096)


def test_dense_rows(spark, m):
    x = dense(m)
    for r in mq.to_dense_rows(m).collect():
        assert np.array_equal(r["vals"], x[r["i"]])
    wide = from_entries(spark, [(1, 3, 2.5)], 3, 4, "double")
    rows = {r["i"]: r["vals"] for r in mq.to_dense_rows(wide, all_rows=True).collect()}
    assert rows == {0: [0.0] * 4, 1: [0, 0, 0, 2.5], 2: [0.0] * 4}
    back = mq.from_dense_rows(mq.to_dense_rows(m), 23, 17, keep_zeros=False)
    assert cells(back) == cells(m)
    with pytest.raises(ValueError):
        mq.to_dense_rows(from_entries(spark, [(0, 0, 1)], 1, limits.DENSE_RECORD_LIMIT + 1))


def test_looks(spark):
    m = from_entries(spark, [(9, 4, 1), (2, 7, 2), (2, 4, 3), (2, 4, 4), (5, 0, 5)])
    first = [(r["i"], r["j"], r["v"]) for r in mq.sample(m, 2).collect()]
    assert first == [(2, 4, 7), (2, 7, 2)]
    corner = {(r["i"], r["j"]): r["v"] for r in mq.preview(m, 2, 2).collect()}
    assert corner == {(2, 0): 0, (2, 4): 7, (5, 0): 5, (5, 4): 0}
    lines = [(r["i"], r["line"]) for r in mq.preview_table(m, 2, 2).collect()]
    assert lines == [(2, "0.0000 7.0000"), (5, "5.0000 0.0000")]


def test_matrix_over_named_columns(spark):
    df = spark.createDataFrame([(1, 2, 0.5)], "a int, b int, x double")
    m = mq.Matrix.of(df, 3, 4, i="a", j="b", v="x")
    assert cells(m) == {(1, 2): 0.5}
    assert m.cells.schema["i"].dataType.simpleString() == "bigint"
    assert m.max_cells() == 12 and mq.Matrix.of(df, i="a", j="b", v="x", nnz=1).max_cells() == 1
