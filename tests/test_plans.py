"""What Catalyst makes of the operators, and which strategy is chosen."""

import pytest

import matrixq as mq
from matrixq.operators.product import broadcast_side, pick_strategy
from matrixq.plans.choose import choose_strategy, default_block
from matrixq.plans.stats import ProductStats, collect_stats, key_work
from matrixq.session import INITIAL_PARTITIONS, scratch_path, tune_scan, tune_shuffle
from matrixq.sources.cells import generate
from matrixq.sources.tables import read_parquet, write_parquet
from tests.conftest import TABLES


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Two factors in parquet, so that plans start from a scan."""
    folder = str(tmp_path_factory.mktemp("factors"))
    write_parquet(generate(spark, 60, 40, 0.3, 1), f"{folder}/a")
    write_parquet(generate(spark, 40, 50, 0.3, 2), f"{folder}/b")
    return (
        read_parquet(spark, f"{folder}/a", 60, 40, unique=True),
        read_parquet(spark, f"{folder}/b", 40, 50, unique=True),
    )


@pytest.fixture
def no_auto_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_plan(stored, no_auto_broadcast):
    plan = plan_of(mq.matmul(*stored, "join").cells)
    assert "SortMergeJoin" in plan and "partial_sum" in plan
    assert plan.count("Exchange hashpartitioning") == 3  # both factors, and the output cells
    assert "isnotnull(j" in plan and "PushedFilters: [IsNotNull(j)]" in plan


def test_broadcast_plan_shuffles_output_cells_only(stored):
    plan = plan_of(mq.matmul(*stored, "broadcast").cells)
    assert "BroadcastHashJoin" in plan and "partial_sum" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_broadcast_falls_back_beyond_its_limit(stored, no_auto_broadcast):
    plan = plan_of(mq.matmul(*stored, "broadcast", broadcast_limit=64).cells)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_broadcast_side(stored):
    a, b = stored
    assert broadcast_side(a, b) == "right"
    assert broadcast_side(a, b, 64 * 599) is None
    undeclared = mq.Matrix(b.cells)
    assert broadcast_side(mq.Matrix(a.cells), undeclared, 64 * 600) == "right"
    assert broadcast_side(mq.Matrix(a.cells), undeclared, 64 * 599) is None
    stats = ProductStats(10, 10**9, 0, 0.0, 0.0)
    assert broadcast_side(mq.Matrix(a.cells), undeclared, 640, stats) == "left"


def test_copartitioned_join_adds_no_exchange(stored, no_auto_broadcast):
    prepared = mq.copartition(*stored, 6).persist()
    plan = plan_of(mq.multiply_prepared(prepared).cells)
    above_cache = plan.split("InMemoryRelation")[0]
    assert "SortMergeJoin" in above_cache
    assert above_cache.count("Exchange") == 1  # the sum per output cell
    prepared.unpersist()


def test_block_plan_has_one_kernel_and_no_cross_join(stored):
    plan = plan_of(mq.matmul(*stored, "block").cells)
    assert plan.count("MapInArrow") == 3  # the kernel, and the packing of each factor
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 2
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_scan_reads_only_needed_columns(spark):
    from matrixq.catalog.queries import mm_gram_join

    plan = plan_of(mm_gram_join(spark, TABLES))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan


def test_preview_has_no_cross_join(stored):
    plan = plan_of(mq.preview(stored[0]))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_stats(stored):
    a, b = stored
    left = a.cells.withColumnRenamed("j", "k")
    right = b.cells.withColumnRenamed("i", "k")
    stats = collect_stats(key_work(left, right, "i", "j"))
    assert (stats.nnz_a, stats.nnz_b) == (720, 600)
    assert stats.products == left.join(right, "k").count()
    assert stats.seen == (60, 40, 50)
    assert stats.work == 720 + 600 + stats.products
    nothing = collect_stats(key_work(left.limit(0), right.limit(0), "i", "j"))
    assert nothing == ProductStats(0, 0, 0, 0.0, 0.0, met_a=0, met_b=0)


@pytest.mark.parametrize("stats,shape,expected", [
    # Dense and of moderate size: tiles.
    (ProductStats(1_250_000, 1_250_000, 312_500_000, 3.2e8, 1e5), (5000, 5000, 5000), "block"),
    (ProductStats(4_000_000, 4_000_000, 8 * 10**9, 8e9, 4e6), (2000, 2000, 2000), "block"),
    # Few products and a side that fits: broadcast.
    (ProductStats(4_000, 4_000, 8_000, 1.6e4, 4), (2000, 2000, 2000), "broadcast"),
    (ProductStats(10**9, 10**3, 10**9, 2e9, 1e6), (10**9, 10**4, 1), "rows"),
    # Large and nearly empty: rows of B go to the rows of A that name them.
    (ProductStats(10**12, 10**11, 10**13, 1e13, 1e4), (10**11, 10**10, 10**9), "rows"),
    # A long dense matrix with its own transpose, small result: tiles in layers.
    (ProductStats(10**11, 10**11, 64 * 10**11, 6e12, 4096), (64, 10**9, 64), "block"),
])
def test_choice(stats, shape, expected):
    block = default_block(shape[0], shape[2], 8)
    assert choose_strategy(stats, *shape, block) == expected


def test_choice_asks_for_the_size_of_the_result_only_where_it_counts():
    asked = []

    def sums():
        asked.append(1)
        return 1e6

    vague = ProductStats(10**5, 10**5, 10**8, 1e8, 1e4)
    shape = (10**6, 10**6, 10**6)
    few = choose_strategy(vague, *shape, 1024, sums=sums)
    many = choose_strategy(vague, *shape, 1024, sums=lambda: 1e8)
    assert asked and (few, many) == ("broadcast", "rows")
    asked.clear()
    dear = ProductStats(1_250_000, 1_250_000, 312_500_000, 3.2e8, 1e5)  # would cost a fifth of the product
    assert choose_strategy(dear, 5000, 5000, 5000, 1024, sums=sums) == "block" and not asked
    assert choose_strategy(ProductStats(10, 10, 20, 40.0, 4.0), 10, 10, 10, 512, sums=sums) == "broadcast"
    assert not asked


def test_vector_needs_no_statistics(spark, stored):
    x = generate(spark, 40, 1, 1.0, 5)
    assert pick_strategy(stored[0], x) == ("broadcast", None)
    assert pick_strategy(x.T, stored[1]) == ("broadcast", None)


def test_default_block():
    assert default_block(10**6, 10**6, 8) == 1024
    assert default_block(2000, 2000, 8) == 512
    assert default_block(64, 64, 8) == 1024


def test_scan_settings(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    tune_scan(spark, min_partitions=12, max_partition_bytes=1 << 20)
    assert spark.conf.get("spark.sql.files.minPartitionNum") == "12"
    assert spark.conf.get("spark.sql.files.maxPartitionBytes").startswith("1048576")
    spark.conf.unset("spark.sql.files.minPartitionNum")
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_shuffle_settings(spark, stored):
    assert tune_shuffle(spark, 1000) == 4
    assert tune_shuffle(spark, 10**9) == 250 == tune_shuffle(spark, 10**6)
    assert tune_shuffle(spark, 10**15) == 32_768
    spark.conf.set(INITIAL_PARTITIONS, "9")
    plan = plan_of(mq.coalesce_cells(mq.Matrix(stored[0].cells)).cells)
    spark.conf.unset(INITIAL_PARTITIONS)
    assert "hashpartitioning(i" in plan and ", 9)" in plan


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    if shared:
        assert path.startswith(shared.rstrip("/"))


def test_dense_records_gather_in_one_shuffle(stored):
    a, _ = stored
    assert plan_of(mq.to_blocks(a, 16)).count("Exchange") == 1
    assert plan_of(mq.to_dense_rows(a)).count("Exchange") == 1
