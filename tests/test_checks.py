"""Checks of products, bitmaps of inner indexes, numbering of long lines."""

import pytest
from pyspark.sql import functions as F

import matrixq as mq
from matrixq.operators.prefilter import bitmaps, with_partner
from matrixq.operators.preview import least_indexes
from matrixq.operators.verify import is_product, product_differences
from matrixq.sources import dense_line
from matrixq.sources.cells import empty, from_entries, generate
from tests.conftest import cells
from tests.test_plans import plan_of


def changed(spark, m, change):
    rows = [(i, j, v) for (i, j), v in cells(m).items()]
    kind = m.value_type.simpleString()
    return from_entries(spark, change(rows), m.n_rows, m.n_cols, kind)


def spoilt(rows):
    """One value changed, one cell left out, one put elsewhere, the whole turned over."""
    i, j, v = rows[3]
    others = rows[:3] + rows[4:]
    free = next(c for c in range(10**6) if all((x, y) != (i, c) for x, y, _ in rows))
    yield [*others, (i, j, v + 1)]
    yield [*others, (i, j, -v)]
    yield others
    yield [*others, (i, free, v)]
    yield [(j, i, v) for i, j, v in rows]


@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_a_product_is_told_from_others(spark, kind):
    a, b = generate(spark, 20, 15, 0.4, 1, kind), generate(spark, 15, 20, 0.4, 2, kind)
    if kind == "double":
        a = a.with_cells(a.cells.selectExpr("i", "j", "v / 7 as v"))
    c = mq.matmul(a, b, "join")
    assert is_product(a, b, c) and is_product(a, b, mq.matmul(a, b, "rows"), seed=5)
    for rows in spoilt([(i, j, v) for (i, j), v in cells(c).items()]):
        wrong = from_entries(spark, rows, 20, 20, kind)
        assert not is_product(a, b, wrong)
    one = changed(spark, c, lambda rows: [(rows[0][0], rows[0][1], rows[0][2] + 1), *rows[1:]])
    found = product_differences(a, b, one).collect()
    assert [r["i"] for r in found] == [next(iter(cells(c)))[0]]


def test_checks_of_large_and_empty_factors(spark):
    big = 2**62
    a = from_entries(spark, [(0, 0, big), (0, 1, -big)], 1, 2)
    b = from_entries(spark, [(0, 0, 1), (1, 0, 1)], 2, 1)
    assert is_product(a, b, from_entries(spark, [(0, 0, 0)], 1, 1))
    assert is_product(a, b, empty(spark, 1, 1, "bigint"))
    assert not is_product(a, b, from_entries(spark, [(0, 0, 1)], 1, 1))
    assert is_product(empty(spark, 2, 2), empty(spark, 2, 2), empty(spark, 2, 2))


def test_bitmaps_tell_partners(spark):
    used = [0, 1, 7, 8, 32_767, 32_768, 32_769, 65_535, 100_001, 10**9]
    asked = sorted({k + d for k in used for d in (-1, 0, 1) if k + d >= 0})
    right = spark.createDataFrame([(k,) for k in used for _ in range(2)], "k long")
    left = spark.createDataFrame([(k, k % 3) for k in asked], "k long, bits long")
    found = with_partner(left, "k", bitmaps(right, "k"))
    assert sorted(r["k"] for r in found.collect()) == used and found.columns == ["k", "bits"]
    assert with_partner(left, "k", bitmaps(right.limit(0), "k")).count() == 0


def test_cells_without_partner_go_before_the_shuffle(spark):
    a = from_entries(spark, [(i, 5 * i, 1) for i in range(200)], 200, 1000)
    b = from_entries(spark, [(k, k % 4, 1) for k in range(0, 1000, 100)], 1000, 4)
    c = mq.matmul(a, b, "join")
    plan = plan_of(c.cells)
    assert "bitmap" in plan.lower()
    assert cells(c) == {(20 * k, (100 * k) % 4): 1 for k in range(10)}
    full = from_entries(spark, [(k, k % 4, 1) for k in range(1000)], 1000, 4)
    assert "bitmap" not in plan_of(mq.matmul(full.T, full, "copartition").cells).lower()


@pytest.mark.parametrize("per_bucket", [1, 2, 1024])
def test_stretches_are_numbered_without_a_single_task(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(dense_line, "FILES_PER_BUCKET", per_bucket)
    rows = [(f"x/part-{f:05d}.txt", f, s, 10 * f + s % 7 + 1, 100 * s) for f in range(9) for s in (0, 64, 128)]
    rows += [("x/other", None, 0, 4, 0), ("x/zother", None, 0, 6, 3)]
    df = spark.createDataFrame(rows, "file string, number long, start long, n long, first long")
    shifts = dense_line.numbered(df)
    plan = plan_of(shifts)
    assert plan.count("Window") == 2 and "SinglePartition" not in plan
    before, expected = 0, {}
    for file, number, start, n, first in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0], r[2])):
        expected[file, start] = before - first
        before += n
    assert {(r["file"], r["start"]): r["shift"] for r in shifts.collect()} == expected


def test_preview_scans_twice(spark, tmp_path):
    from matrixq.sources.tables import read_parquet, write_parquet

    m = generate(spark, 50, 40, 0.1, 3)
    write_parquet(m, str(tmp_path / "m"))
    stored = read_parquet(spark, str(tmp_path / "m"), 50, 40, unique=True)
    rows, cols = least_indexes(stored, 3, 4)
    held = cells(m)
    assert rows == sorted({i for i, _ in held})[:3] and cols == sorted({j for _, j in held})[:4]
    corner = mq.preview(stored, 3, 4)
    plan = plan_of(corner)
    assert plan.count("FileScan") == 1 and "PushedFilters: [In(i" in plan
    assert {(r["i"], r["j"]): r["v"] for r in corner.collect()} == {
        (i, j): held.get((i, j), 0) for i in rows for j in cols
    }
    assert mq.preview(empty(spark, 2, 2)).count() == 0
    assert mq.preview_table(stored.with_cells(stored.cells.where(F.col("i") < 0))).count() == 0
