"""The product by tiles.

The output is cut into tiles of ``block x block``, and groups of neighbouring tiles are the work of
a task each. The cells of either factor are packed where they are into pieces of tiles, and each
piece is sent once to every group of output tiles that it can contribute to. A group sums up its
tiles where the pieces arrive, and nothing but finished cells leaves the task. So there is one
shuffle, of ``nnz(A) * groups across + nnz(B) * groups down`` packed cells, instead of one row per
multiplication. When the output has fewer groups than the cluster has cores, or the inner index is
very long, it is dealt out over several layers and the partial tiles are summed.

Large matrices whose tiles are nearly empty have more of these than cells to put in them. There a
piece takes in many tiles along the inner index, so pieces and steps follow the cells and not the
tiles, groups are larger, and there are layers only for want of groups, as partial sums of such
tiles are as many as the products.

With a matrix times its own transpose the pieces of both sides are the same. Only the groups on
and above the diagonal are formed, and those on it get one copy of their pieces and turn it over.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixq.functions import cell_products, tile_kernel
from matrixq.functions.tile_kernel import GROUP_KEYS, pieces_of_tiles, tile_sums
from matrixq.model import Matrix, value_type_of
from matrixq.operators.aggregates import infer_dims
from matrixq.operators.cells import coalesce_cells
from matrixq.operators.gram import mirror
from matrixq.plans.choose import default_block
from matrixq.plans.limits import MAX_PARTITIONS, fits_broadcast
from matrixq.session import tune_for

# Pairs of tiles a task should multiply for one output tile, some 20 seconds of full ones.
TILE_PAIRS_PER_TASK = 256
# Output tiles on an edge of a group: nine sums of 8 MB in a task; more where tiles are nearly empty.
GROUP_EDGE, SPARSE_GROUP_EDGE = 3, 4
# From this many pairs of tiles on cells are counted; a smaller share of places is nearly empty.
MANY_PAIRS, NEARLY_EMPTY = 1024, 1 / 32
# Places of a side that a step may span, and packed pieces of a task's batch of cells.
STEP_PLACES, BATCH_PIECES = 1 << 26, 1 << 11
# Small tiles are merged up to this edge.
MERGED_EDGE = 1024
# Up to this many groups a piece is sent to all of them; beyond, only to those that have a tile
# for it to meet.
SENT_TO_ALL = 8
# Tasks that one inner tile's pieces are spread over where they are joined.
SPREAD = 64

# The kernel travels to the workers with the plan, so they need not have this package.
cloudpickle.register_pickle_by_value(tile_kernel)
cloudpickle.register_pickle_by_value(cell_products)


def block_product(a: Matrix, b: Matrix, *, block: int | None = None, layers: int | None = None,
                  symmetric: bool = False, seen: tuple[int, int, int] | None = None,
                  keep_zeros: bool = True, group: int | None = None) -> Matrix:
    """``A x B`` by tiles. Cells that cancel to zero stay, as in the other plans, unless
    ``keep_zeros=False``.

    With ``symmetric`` ``A`` is the transpose of ``B``, and only the tiles on and above the
    diagonal are computed. ``seen``: rows, inner size and columns that the cells are
    known to show; without it a shape that is not declared costs a job. ``group``: output tiles
    on an edge of a task's group. Without ``group`` and ``layers``, neighbouring tiles of a small
    ``block`` are merged where there are many.
    """
    if seen is not None:
        a, b = _declare(a, seen[0], seen[1]), _declare(b, seen[1], seen[2])
    tune_for(a.spark, *(m.cells for m in (a, b) if not m.unique))
    a, b = infer_dims(a), infer_dims(b)
    cores = a.spark.sparkContext.defaultParallelism
    block = block or default_block(a.n_rows, b.n_cols, cores)
    if group is None and layers is None:
        block *= _merged_tiles(a.n_rows, b.n_cols, block, cores)
    down, across = _tiles(a.n_rows, block), _tiles(b.n_cols, block)
    deep = _tiles(max(a.n_cols, b.n_rows), block)
    value_type = value_type_of(a, b)
    sparse = group is None and layers is None and _nearly_empty(a, b, down * across * deep)
    if layers is None:
        layers = 1 if sparse else min(deep, max(-(-cores // (down * across)), -(-deep // TILE_PAIRS_PER_TASK)))
    if group is None:
        fits = [g for g in range(1, (SPARSE_GROUP_EDGE if sparse else GROUP_EDGE) + 1)
                if _tiles(down, g) * _tiles(across, g) * layers >= cores]
        group = max(fits, default=1)
    groups_down, groups_across = _tiles(down, group), _tiles(across, group)
    inner_tiles = 1
    if sparse:
        layers = min(deep, max(1, -(-cores // (groups_down * groups_across))))
        most = max(1, min(STEP_PLACES // (group * block), 1 << 16) // block)
        inner_tiles = min(most, _tiles(max(groups_down, groups_across) * deep, BATCH_PIECES), -(-deep // layers))
    span, chunk = block * group, block * inner_tiles

    left = _pieces(a, span, chunk, value_type, transposed=False)
    right = _pieces(b, span, chunk, value_type, transposed=True)
    deep = _tiles(deep, inner_tiles)
    sent_left = _send(left, "gi", "gj", span, groups_across, b, chunk, "j", "i", deep)
    sent_right = _send(right, "gj", "gi", span, groups_down, a, chunk, "i", "j", deep)
    if symmetric:
        # The groups on the diagonal take their left pieces from the right ones.
        sent_left, sent_right = sent_left.where("gi < gj"), sent_right.where("gi <= gj")
    sent = sent_left.withColumn("side", F.lit(0)).unionByName(sent_right.withColumn("side", F.lit(1)))
    sent = sent.withColumn("layer", F.col("bk") % layers)

    places = groups_down * groups_across * layers
    tasks = max(1, min(MAX_PARTITIONS, places))
    place = (F.col("gi") * groups_across + F.col("gj")) * layers + F.col("layer")
    if places > tasks:  # several to a task: not all of one column, as a rest would
        place = F.xxhash64(place)
    arranged = sent.repartitionById(tasks, F.pmod(place, F.lit(tasks)).cast("int")).select(
        *GROUP_KEYS, "side", "n", "kind", "data"
    ).sortWithinPartitions(*GROUP_KEYS, "side")
    shape = (a.n_rows, max(a.n_cols, b.n_rows), b.n_cols)
    kernel = tile_sums(block, span, chunk, shape, value_type == "bigint", symmetric)
    cells = arranged.mapInArrow(kernel, f"i bigint, j bigint, v {value_type}")
    if layers > 1:
        cells = cells.groupBy("i", "j").agg(F.sum("v").cast(value_type).alias("v"))
    if not keep_zeros:
        cells = cells.where("v <> 0")
    if symmetric:
        cells = mirror(cells.where("i <= j"))
    return Matrix(cells, a.n_rows, b.n_cols, unique=True)


def _declare(m: Matrix, n_rows: int, n_cols: int) -> Matrix:
    return replace(
        m, n_rows=n_rows if m.n_rows is None else m.n_rows,
        n_cols=n_cols if m.n_cols is None else m.n_cols,
    )


def _merged_tiles(n_rows: int, n_cols: int, block: int, cores: int) -> int:
    """Tiles on an edge that are multiplied as one: small tiles of a large matrix hold a few cells
    each, and steps and copies would grow with the square of their number."""
    merged = 1
    while 2 * merged * block <= MERGED_EDGE and _tiles(n_rows, 2 * merged * block) * _tiles(
            n_cols, 2 * merged * block) >= 2 * cores:
        merged *= 2
    return merged


def _tiles(extent: int, block: int) -> int:
    return max(1, -(-extent // block))


def _nearly_empty(a: Matrix, b: Matrix, pairs: int) -> bool:
    """Whether the tiles of large matrices hold few cells. Runs a job for each side if there are
    many pairs of tiles, none otherwise."""
    return pairs >= MANY_PAIRS and all(
        m.cells.count() < NEARLY_EMPTY * m.n_rows * m.n_cols for m in (a, b)
    )


def _pieces(m: Matrix, span: int, chunk: int, value_type: str, transposed: bool) -> DataFrame:
    """Rows ``(outer, inner, n, kind, data)``: cells of one place, packed by each task."""
    cells = coalesce_cells(m).cells.select("i", "j", F.col("v").cast(value_type).alias("v"))
    return cells.mapInArrow(
        pieces_of_tiles(span, chunk, transposed, value_type == "bigint"),
        "outer bigint, inner bigint, n int, kind int, data binary",
    )


def _send(pieces: DataFrame, own: str, other: str, span: int, groups: int, factor: Matrix,
          chunk: int, outer: str, inner: str, deep: int) -> DataFrame:
    """A copy of each piece for every group along the other side that has a cell to meet it.

    Few groups get all pieces. For many, the other factor's places are listed first; where the
    list is too long for a broadcast, it is joined, each step's pieces spread over ``SPREAD`` tasks.
    """
    rows = pieces.select(F.col("outer").alias(own), F.col("inner").alias("bk"), "n", "kind", "data")
    if groups <= SENT_TO_ALL:
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))))
    present = factor.cells.select(
        F.expr(f"{outer} div {span}").alias(other), F.expr(f"{inner} div {chunk}").alias("bk"),
    ).distinct()
    if fits_broadcast(deep * groups):
        return rows.join(F.broadcast(present), "bk")
    spread = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    rows = rows.withColumn("spread", F.pmod(F.xxhash64(own, "data"), F.lit(SPREAD)).cast("int"))
    return rows.join(present.withColumn("spread", spread), ["bk", "spread"]).drop("spread")
