"""Readers and writers: text policies, dense lines, tables, generated matrices."""

import numpy as np
import pytest

import matrixq as mq
from matrixq.plans import skew
from matrixq.sources import cells as src
from matrixq.sources.dense_line import read_dense_line, write_dense_line
from matrixq.sources.tables import read_parquet, read_prepared, write_parquet, write_prepared
from matrixq.sources.text import parse_cells, read_cells, source_info, write_cells
from tests.conftest import cells, dense

LINES = ["0,0,1.5", "", "bad", "1,2", "0,1,x", "1,1,2.0,9", "2.0,1.0,3e0", " 1, 2, 3 "]


def lines_of(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def parsed(spark, lines, policy):
    return sorted((*k, v) for k, v in cells(parse_cells(lines_of(spark, lines), policy)).items())


def test_permissive(spark):
    assert parsed(spark, LINES, "permissive") == [(0, 0, 1.5), (1, 2, 3.0), (2, 1, 3.0)]


def test_permissive_edges(spark):
    lines = ["2.5,3.5,1", "-1,0,4", "nan,0,1", "0,inf,1", "0,0,nan", "0,1,-inf", "a,b,c", "1,1,"]
    found = parsed(spark, lines, "permissive")
    assert [f[:2] for f in found] == [(0, 0), (0, 1), (2, 4)]  # halves round to even
    assert np.isnan(found[0][2]) and found[1][2] == float("-inf")


def test_counted(spark):
    good = ["0,0,1.5", "", "1,2", "1,1,2.0,9", " 1, 2, 3 "]
    assert parsed(spark, good, "skip_bad_shape") == [(0, 0, 1.5), (1, 2, 3.0)]
    for bad in ("0,1,x", "2.0,1.0,3e0"):
        with pytest.raises(Exception, match="not a matrix cell"):
            parsed(spark, [*good, bad], "skip_bad_shape")


def test_strict(spark):
    good = ["0,0,1.5", "1,1,2.0,9", " 1, 2, 3 "]
    assert parsed(spark, good, "strict") == [(0, 0, 1.5), (1, 1, 2.0), (1, 2, 3.0)]
    for bad in ("", "bad", "1,2", "0,1,x", "2.0,1.0,3e0"):
        with pytest.raises(Exception, match="not a matrix cell"):
            parsed(spark, [*good, bad], "strict")


def test_unknown_policy(spark):
    with pytest.raises(ValueError, match="policy"):
        parse_cells(lines_of(spark, LINES), "loose")


def test_text_round_trip(spark, folder):
    m = src.generate(spark, 30, 20, 0.3, seed=4)
    write_cells(m, f"{folder}/m")
    back = read_cells(spark, f"{folder}/m", "strict", n_rows=30, n_cols=20)
    assert cells(back) == cells(m)
    files = source_info(spark, f"{folder}/m").collect()
    expected = sum(len(f"{i},{j},{v}\n") for (i, j), v in cells(m).items())
    assert sum(f["size_bytes"] for f in files) == expected
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_cells(spark, f"{folder}/absent")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        source_info(spark, f"{folder}/absent")


def test_parquet_round_trip(spark, folder):
    m = src.generate(spark, 30, 20, 0.3, seed=4)
    write_parquet(m, f"{folder}/p")
    assert cells(read_parquet(spark, f"{folder}/p", 30, 20, unique=True)) == cells(m)


@pytest.mark.parametrize("floor", [skew.WORK_FLOOR, 60])
def test_bucketed_factors_join_without_a_shuffle(spark, folder, monkeypatch, floor):
    monkeypatch.setattr(skew, "WORK_FLOOR", floor)
    a, b = src.generate(spark, 30, 20, 0.3, 1), src.generate(spark, 20, 25, 0.3, 2)
    prepared = mq.copartition(a, b, 4)
    assert (len(prepared.keys) == 3) == (floor == 60)
    write_prepared(prepared, "factors", f"{folder}/factors")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        c = mq.multiply_prepared(read_prepared(spark, "factors", prepared))
        plan = c.cells._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1  # the sum per output cell
        assert np.array_equal(dense(c), dense(a) @ dense(b))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table factors_left")
        spark.sql("drop table factors_right")


def line_file(folder, text):
    path = f"{folder}/line.txt"
    with open(path, "w") as f:
        f.write(text)
    return path


def test_dense_line(spark, folder):
    path = line_file(folder, "\n1.0, 2.0,0,4.0,5.0,6.0\n\n")
    m = read_dense_line(spark, path, 2, 3)
    assert np.array_equal(dense(m), [[1, 2, 0], [4, 5, 6]])
    assert len(cells(read_dense_line(spark, path, 2, 3, keep_zeros=False))) == 5


def test_dense_line_bad_value(spark, folder):
    path = line_file(folder, "1.0, 2.0,x,4.0,5.0,6.0")
    with pytest.raises(Exception, match="not a number"):
        read_dense_line(spark, path, 2, 3).cells.collect()
    shifted = read_dense_line(spark, path, 2, 3, on_bad="shift")
    assert cells(shifted) == {(0, 0): 1, (0, 1): 2, (0, 2): 4, (1, 0): 5, (1, 1): 6}
    assert len(cells(read_dense_line(spark, path, 2, 2, on_bad="shift"))) == 4
    with pytest.raises(ValueError):
        read_dense_line(spark, path, 2, 3, on_bad="ignore")


@pytest.mark.parametrize("on_bad", ["error", "shift"])
@pytest.mark.parametrize("text", ["1,2\n3,4", "1,2,\n3,4", "1,2\n,3,4"])
def test_dense_line_takes_one_line(spark, folder, text, on_bad):
    with pytest.raises(Exception, match="more than one line|expected 2 x 2 values"):
        read_dense_line(spark, line_file(folder, text), 2, 2, on_bad=on_bad).cells.collect()


def test_dense_line_wrong_count(spark, folder):
    path = line_file(folder, "1,2,3")
    with pytest.raises(Exception, match="expected 2 x 2 values, found 3"):
        read_dense_line(spark, path, 2, 2).cells.collect()


def test_dense_line_checks_come_first(spark, folder):
    for text in ("1,2,3", "", "1,2,x,4"):
        with pytest.raises(ValueError):
            read_dense_line(spark, line_file(folder, text), 2, 2)


def test_dense_line_counts_columns(spark, folder):
    m = read_dense_line(spark, line_file(folder, "1,2,3,4,5,6"), 2)
    assert m.shape == (2, 3) and np.array_equal(dense(m), [[1, 2, 3], [4, 5, 6]])
    with pytest.raises(ValueError, match="expected 4 x 1 values, found 6"):
        read_dense_line(spark, line_file(folder, "1,2,3,4,5,6"), 4)


@pytest.mark.filterwarnings("ignore:.*values for")
@pytest.mark.parametrize("on_bad", ["error", "shift"])
def test_dense_line_in_many_splits(spark, folder, on_bad):
    values = np.arange(6000) * 37 % 1009
    path = line_file(folder, ",".join(str(v) for v in values))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        m = read_dense_line(spark, path, 60, 100, on_bad=on_bad)
        assert spark.read.option("lineSep", ",").text(path).rdd.getNumPartitions() > 10
        assert np.array_equal(dense(m), values.reshape(60, 100))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_dense_line_round_trip(spark, folder):
    m = src.generate(spark, 37, 11, 0.3, seed=8, value_type="double")
    write_dense_line(m, f"{folder}/line")
    assert np.array_equal(dense(read_dense_line(spark, f"{folder}/line", 37, 11)), dense(m))


@pytest.mark.parametrize("density", [0, 0.003, 0.05, 0.5, 0.7, 1])
def test_generate(spark, density):
    m = src.generate(spark, 40, 50, density, seed=3)
    found = cells(m)
    assert len(found) == round(density * 2000)
    assert all(0 <= i < 40 and 0 <= j < 50 and 1 <= v <= 9 for (i, j), v in found.items())
    assert cells(src.generate(spark, 40, 50, density, seed=3, num_partitions=3)) == found
    if 0 < density < 1:
        assert cells(src.generate(spark, 40, 50, density, seed=4)) != found


def test_generate_beyond_64_bits(spark):
    m = src.generate(spark, 10**9, 10**9, 1e-15, seed=3)
    found = cells(m)
    assert len(found) == 1000 and max(i for i, _ in found) > 9 * 10**8


def test_generate_checks_density(spark):
    with pytest.raises(ValueError):
        src.generate(spark, 3, 3, 1.5)


def test_empty_and_identity(spark):
    assert src.empty(spark, 4, 5).shape == (4, 5) and mq.is_empty(src.empty(spark, 4, 5))
    assert np.array_equal(dense(src.identity(spark, 3)), np.eye(3))


def test_dense_line_parts_go_by_number(spark, tmp_path):
    for number, text in (("99999", "1,2,"), ("100000", "3,4,"), ("100001", "5,6,")):
        (tmp_path / f"part-{number}-x.txt").write_text(text)
    m = read_dense_line(spark, str(tmp_path), 2, 3)
    assert np.array_equal(dense(m), [[1, 2, 3], [4, 5, 6]])
