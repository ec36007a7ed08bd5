"""Plans whose copies, tasks or sums once grew faster than their input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import matrixq as mq
from matrixq.operators import blocks, product, rowwise
from matrixq.operators.verify import product_differences
from matrixq.plans import skew, stats
from matrixq.sources.cells import from_entries, generate
from tests.conftest import cells, dense


def plan_of(m) -> str:
    return m.cells._jdf.queryExecution().executedPlan().toString()


def test_join_shuffles_rows_and_no_products(spark, monkeypatch):
    monkeypatch.setattr(stats, "PRODUCTS_PER_TASK", 1000)
    a, b = generate(spark, 40, 30, 0.5, 1), generate(spark, 30, 40, 0.5, 2)
    c = mq.matmul(a, b, "join")
    assert "collect_list" in plan_of(c) and np.array_equal(dense(c), dense(a) @ dense(b))
    # A row with too many products goes by partial sums.
    monkeypatch.setattr(product, "LINE_SLACK", 0)
    c = mq.matmul(a, b, "join")
    assert "collect_list" not in plan_of(c) and np.array_equal(dense(c), dense(a) @ dense(b))


@pytest.mark.parametrize("big", [7, 1 << 40])
@pytest.mark.parametrize("strategy", ["join", "rows"])
def test_values_of_any_size_travel(spark, monkeypatch, strategy, big):
    monkeypatch.setattr(stats, "PRODUCTS_PER_TASK", 10)
    monkeypatch.setattr(rowwise, "NAMES_ALL", 10**9)
    entries = [(k, j, (big if j else 3) * (-1) ** k) for k in range(6) for j in range(9)]
    a, b = from_entries(spark, [(i, k, i + 1) for i in range(8) for k in range(6)], 8, 6), from_entries(spark, entries, 6, 9)
    whole = {(i, j): sum((i + 1) * v for _, at, v in entries if at == j) for i in range(8) for j in range(9)}
    assert cells(mq.matmul(a, b, strategy)) == whole


def test_duplicates_make_no_tasks_and_hide_no_hot_index(spark, monkeypatch):
    monkeypatch.setattr(stats, "PRODUCTS_PER_TASK", 1000)
    monkeypatch.setattr(skew, "MAX_HOT", 20)
    a = mq.Matrix(spark.range(400).selectExpr("id i", "id % 2 j", "1L v"), 400, 2, unique=True)
    b = mq.Matrix(spark.range(20_000).selectExpr("id % 2 i", "id % 50 j", "1L v"), 2, 50)
    c = mq.matmul(a, b, "join", work_floor=500)
    plan = c.cells._jdf.queryExecution().analyzed().toString()
    assert "part_l" in plan and "Repartition 10, " not in plan
    assert " 8000," not in plan_of(c) and len(cells(c)) == 400 * 25


def test_hot_rows_are_not_copied_to_all_of_their_parts(spark):
    """Each inner index has one column, so each cell of the long row goes to one part only."""
    a = from_entries(spark, [(0, k, 1) for k in range(400)], 1, 400)
    b = from_entries(spark, [(k, k, k + 1) for k in range(400)], 400, 400)
    c = rowwise.row_product(a, b, part_products=4)
    assert cells(c) == {(0, k): k + 1 for k in range(400)}
    assert "explode(sequence" not in plan_of(c)


@pytest.mark.parametrize("piece", [1, 5, 1 << 16])
def test_long_rows_of_b_come_in_pieces(spark, monkeypatch, piece):
    monkeypatch.setattr(rowwise, "NAMES_ALL", 10**9)
    monkeypatch.setattr(rowwise, "ROW_PIECE", piece)
    a, b = generate(spark, 30, 20, 0.3, 1), generate(spark, 20, 40, 0.6, 2)
    assert np.array_equal(dense(rowwise.row_product(a, b)), dense(a) @ dense(b))


def test_undeclared_rows_are_sketched_in_part(spark, monkeypatch):
    monkeypatch.setattr(stats, "SKETCHED_ROWS", 10)
    a, b = generate(spark, 400, 50, 0.2, 1), generate(spark, 50, 40, 0.2, 2)
    seen = []
    per_row = stats._per_row
    monkeypatch.setattr(stats, "_per_row", lambda x, y, s: seen.append(x.where(s).select("i").distinct().count()) or per_row(x, y, s))
    work = stats.row_work(mq.Matrix(a.cells, unique=True), b)
    assert 0 < seen[0] < 100 and work.rows == a.cells.agg(F.max("i") + 1).first()[0]


def test_small_tiles_are_merged(spark):
    assert blocks._merged_tiles(6000, 6000, 32, 8) == 32
    assert blocks._merged_tiles(100, 100, 32, 8) == 1
    assert blocks._merged_tiles(10**6, 10**6, 1024, 8) == 1
    m = generate(spark, 60, 300, 0.05, 1)
    expected = dense(m).T @ dense(m)
    assert np.array_equal(dense(mq.matmul(m.T, m, "block", block=4)), expected)
    assert np.array_equal(dense(mq.gram(m, strategy="block", block=4)), expected)


def test_every_row_of_a_check(spark):
    a, b = from_entries(spark, [(0, 0, 1), (1, 0, 2)], 3, 1), from_entries(spark, [(0, 0, 5)], 1, 1)
    c = from_entries(spark, [(0, 0, 5), (2, 0, 1)], 3, 1)
    rows = product_differences(a, b, c, every_row=True).select("i", "in_c", "differs").collect()
    assert {tuple(r) for r in rows} == {(0, True, False), (1, False, True), (2, True, True)}


def test_nearly_empty_tiles_make_no_layers(spark):
    """A long inner index of nearly empty tiles: no partial tile is summed once more."""
    rng = np.random.default_rng(5)
    entries = [(int(i), int(k), int(v)) for i, k, v in zip(
        rng.integers(0, 2000, 3000), rng.integers(0, 10**6, 3000) // 5000 * 5000 + 7, rng.integers(1, 9, 3000))]
    a = mq.Matrix(spark.createDataFrame(sorted(dict(((i, k), v) for i, k, v in entries).items()), "at struct<i:bigint,j:bigint>, v bigint").select("at.*", "v"), 2000, 10**6, unique=True)
    c = mq.matmul(a, a.T, "block", block=32)
    assert "HashAggregate" not in plan_of(c)
    assert cells(c) == cells(mq.matmul(a, a.T, "join", split_hot=False))


@pytest.mark.parametrize("places", [1 << 26, 64])
@pytest.mark.parametrize("block", [2, 7])
def test_steps_over_many_inner_tiles(spark, monkeypatch, places, block):
    """Wide steps with empty, sparse and full tiles, cells that cancel, and the half of a Gram product."""
    for name, value in (("MANY_PAIRS", 1), ("NEARLY_EMPTY", 2), ("BATCH_PIECES", 4), ("SENT_TO_ALL", 1), ("STEP_PLACES", places)):
        monkeypatch.setattr(blocks, name, value)
    a, b = generate(spark, 40, 90, 0.1, 1), generate(spark, 90, 33, 0.3, 2)
    full = a.cells.unionByName(spark.range(14 * 14).selectExpr("id div 14 i", "id % 14 j", "if(id % 2 = 0, 1L, -1L) v"))
    a = mq.coalesce_cells(a.with_cells(full.withColumn("v", F.col("v").cast("bigint")), unique=False))
    expected = cells(mq.matmul(a, b, "join"))
    assert 0 in expected.values()
    assert cells(mq.matmul(a, b, "block", block=block)) == expected
    assert cells(mq.matmul(a, b, "block", block=block, keep_zeros=False)) == {at: v for at, v in expected.items() if v}
    assert cells(mq.gram(a, strategy="block", block=block)) == cells(mq.matmul(a.T, a, "join"))


def test_cancelled_cells_stay_in_nearly_empty_tiles(spark):
    """Two cells of each line cancel, 700,000 inner indexes apart."""
    rows = spark.range(600).selectExpr("id % 300 * 6 i", "300 * (id % 2) + 700000 * (id div 300) j", "if(id < 300, 1L, -1L) v")
    a = mq.Matrix(rows, 1800, 10**6, unique=True)
    ones = mq.Matrix(a.cells.select("i", "j", F.lit(1).cast("bigint").alias("v")), 1800, 10**6, unique=True)
    c = mq.matmul(a, ones.T, "block", block=32)
    assert "HashAggregate" not in plan_of(c)
    expected = cells(mq.matmul(a, ones.T, "join"))
    assert cells(c) == expected and set(expected.values()) == {0}
    assert cells(mq.matmul(a, ones.T, "block", block=32, keep_zeros=False)) == {}


def test_gram_of_nearly_empty_tiles_makes_no_layers(spark):
    rows = spark.range(4000).selectExpr("id * 7919 % 1000 * 997 i", "id * 31 % 1999 j", "id % 9 - 4 v")
    m = mq.Matrix(mq.coalesce_cells(mq.Matrix(rows)).cells.localCheckpoint(), 10**6, 2000, unique=True)
    c = mq.gram(m, strategy="block", block=32)
    assert "HashAggregate" not in plan_of(c)
    assert cells(c) == cells(mq.matmul(m.T, m, "join"))


@pytest.mark.parametrize("whole", [True, False])
@pytest.mark.parametrize("wide", [True, False])
def test_rows_are_packed_in_few_bytes(whole, wide):
    """Gaps and values of all sizes come back, and small ones take a byte each."""
    import pyarrow as pa

    from matrixq.functions import row_kernel as kernel

    top = 1 << (40 if wide else 30)
    rows = {3: [(5, 1), (6, -128), (200, 127)], 4: [(0, 300), (70_000, 2)], 6: [(9, 1 << 40)], top: [(0, 70_000), (500, 1), (top, -(1 << 62))]}
    k, x, v = (np.array(c) for c in zip(*((at, j, y) for at, row in rows.items() for j, y in row)))
    v = v if whole else v / 2
    given = pa.RecordBatch.from_arrays([pa.array(k), pa.array(x), pa.array(v)], names=["k", "x", "v"])
    packed, = kernel.pack_rows(whole, wide)(iter([given]))
    assert packed.num_rows == len(rows)
    assert len(packed["x"][0].as_py()) == (16 if wide else 8) + 3 and len(packed["v"][0].as_py()) == (3 if whole else 24)
    found = []
    for r, kind in enumerate(packed["kind"].to_pylist()):
        size, held = divmod(kind - kernel.ROW, 4)
        inner, col = kernel._places(packed, r, r + 1, kernel.GAPS[size], np.dtype(np.int64 if wide else np.int32))
        t = kernel.VALUES[held] if whole or held < 3 else np.dtype(np.float64)
        found += zip(inner.tolist(), col.tolist(), kernel._flat(packed, "v", r, r + 1, t)[0].tolist())
    assert found == list(zip(k.tolist(), x.tolist(), v.tolist()))


def test_parts_get_bytes_and_no_arrays(spark, monkeypatch):
    monkeypatch.setattr(rowwise, "NAMES_ALL", 10**9)
    a, b = generate(spark, 30, 20, 0.3, 1), generate(spark, 20, 40, 0.6, 2)
    c = rowwise.row_product(mq.Matrix(a.cells), mq.Matrix(b.cells))
    assert cells(c) == cells(mq.matmul(a, b, "join")) and "collect_list" not in plan_of(c)


@pytest.mark.parametrize("cols,kind", [(200_000, "tinyint"), (1 << 40, "smallint")])
def test_join_sends_rows_in_halves_and_small_values(spark, monkeypatch, cols, kind):
    monkeypatch.setattr(stats, "PRODUCTS_PER_TASK", 10)
    entries = [(k, j * (cols // 9), (-1) ** j * (40 if kind == "tinyint" else 4000 * k)) for k in range(6) for j in range(9)]
    entries += [(0, 65_535, 1), (0, 65_536, 2), (0, cols - 1, 1 << 40)]
    a, b = from_entries(spark, [(i, k, i + 1) for i in range(8) for k in range(6)], 8, 6), from_entries(spark, entries, 6, cols)
    c = mq.matmul(a, b, "join")
    plan = plan_of(c)
    assert "array<tinyint>" in plan and ("upper" in plan) == (cols < 1 << 31)
    expected = {}
    for k, j, v in entries:
        for i in range(8):
            expected[i, j] = expected.get((i, j), 0) + (i + 1) * v
    assert cells(c) == expected


def test_row_lengths_are_counted_without_sums_first(spark, monkeypatch):
    """Duplicates are summed only where they might be what makes a row too long."""
    calls = []
    monkeypatch.setattr(product, "coalesce_cells", lambda m: calls.append(m) or mq.coalesce_cells(m))
    a, b = mq.Matrix(spark.range(100).selectExpr("id % 10 i", "id % 5 j", "1L v"), 10, 5), generate(spark, 5, 8, 1.0, 1)
    assert product._longest_row(a, b) == 80 and not calls
    monkeypatch.setattr(product, "LINE_SLACK", 0)
    assert product._longest_row(a, b) == 8 and calls


def test_only_named_rows_are_sketched(spark, monkeypatch):
    """Where few rows of ``A`` stand for all, no other row of ``B`` gets a sketch."""
    monkeypatch.setattr(stats, "SKETCHED_ROWS", 4)
    a, b = generate(spark, 400, 300, 0.005, 1), generate(spark, 300, 40, 0.2, 2)
    step = F.pmod(F.xxhash64("i"), F.lit(100)) == 0
    named = {r[0] for r in a.cells.where(step).select("j").distinct().collect()}
    sums = {r["i"]: r["sums"] for r in stats._per_row(a.cells, b.cells, step).collect() if r["sums"] is not None}
    x, y = dense(a) != 0, dense(b) != 0
    assert sums == {i: int((x[i].astype(int) @ y > 0).sum()) for i in sums} and sums
    plan = stats._sketched_sums(a.cells.where(step), b.cells)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and 0 < len(named) < 100
    work = stats.row_work(a, b)
    assert work.products == int((x.astype(int) @ y).sum()) and work.longest == int(y[x.any(0)].sum(1).max())


def test_zeros_are_dropped_from_rows_of_small_values(spark, monkeypatch):
    monkeypatch.setattr(stats, "PRODUCTS_PER_TASK", 10)
    rows = spark.range(48).selectExpr("id % 6 i", "id div 6 * 9000 j", "if(id % 6 < 3, 1L, -1L) v")
    a, b = mq.Matrix(spark.range(240).selectExpr("id div 6 i", "id % 6 j", "if(id < 6, 2L, 1L + id % 3) v"), 40, 6), mq.Matrix(rows, 6, 80_000)
    c = mq.matmul(a, b, "join", keep_zeros=False)
    assert "array<tinyint>" in plan_of(c) and cells(c) == {}
    assert set(cells(mq.matmul(a, b, "join")).values()) == {0}


@pytest.mark.parametrize("of", ["gram", "column heavy", "verified"])
def test_packed_rows_in_queries_of_the_row_plan(spark, monkeypatch, of):
    """Duplicates, hot rows and rows of B in pieces, each sent as bytes."""
    for name, value in (("NAMES_ALL", 10**9), ("ROW_PIECE", 4)):
        monkeypatch.setattr(rowwise, name, value)
    m = mq.Matrix(spark.range(900).selectExpr("id * 7 % 60 i", "id * id % 37 j", "id % 300 - 150 v"), 60, 37)
    b = m.T if of == "column heavy" else m
    c = mq.gram(m, strategy="rows") if of == "gram" else mq.matmul(b.T, b, "rows")
    assert "array<" not in plan_of(c) and cells(c) == cells(mq.matmul(b.T, b, "join"))
    if of == "verified":
        assert product_differences(b.T, b, c).count() == 0


def test_auto_join_takes_packed_rows(spark, monkeypatch):
    """``auto`` without a broadcast, where the row-wise plan is the cheapest."""
    monkeypatch.setattr(rowwise, "NAMES_ALL", 10**9)
    monkeypatch.setattr(product, "pick_strategy", lambda *_, **limits: ("rows" if limits["broadcast_limit"] == 0 else "join", None))
    a, b = mq.Matrix(generate(spark, 30, 20, 0.3, 1).cells), mq.Matrix(generate(spark, 20, 40, 0.6, 2).cells)
    c = mq.matmul(a, b, broadcast_limit=0)
    assert "array<" not in plan_of(c) and cells(c) == cells(mq.matmul(a, b))
