"""Which plan a product takes when the caller leaves it open."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from matrixq.plans.limits import BROADCAST_LIMIT_BYTES, fits_broadcast, number_of_parts
from matrixq.plans.stats import ProductStats

# Share of what the cheapest plan should take that an estimate may cost.
WORTH = 0.1

# Seconds of one core, fitted to runs of bench.py over the workloads of matrixq.bench.
SECONDS_PER_PRODUCT = 1e-7  # join two cells, add to a sum that stays in the task
SECONDS_PER_SHUFFLED_PRODUCT = 2e-6  # the same where the sum is shuffled
SECONDS_PER_SUM = 4e-6  # a sum of the broadcast plan
SECONDS_PER_SHIPPED_CELL = 2e-7  # copy a packed cell to one part or group of tiles
SECONDS_PER_PAIR = 4.5e-8  # multiply two cells in the kernel of tiles
SECONDS_PER_ROW_PAIR = 1.5e-7  # and in that of rows, whose sums are further apart
SECONDS_PER_FLOP = 1e-10  # dense kernel; a multiplication and an addition count as two
SECONDS_PER_GIVEN_CELL = 3e-7  # a cell of the result that leaves a kernel
SECONDS_PER_SKETCHED_CELL = 3e-6  # estimate the cells of the result
KERNEL_STAGES_SECONDS = 8.0  # what the stages of a plan with kernels cost at the least
CELL_STAGES_SECONDS = 4.0  # and those of the others


@dataclass(frozen=True)
class Shape:
    """Rows, inner size and columns of a product, and the tiles it would be cut into."""

    n_rows: int
    n_inner: int
    n_cols: int
    block: int

    def tiles(self) -> tuple[int, int, int]:
        return tuple(max(1, -(-n // self.block)) for n in (self.n_rows, self.n_inner, self.n_cols))


def default_block(n_rows: int, n_cols: int, cores: int) -> int:
    """The edge of a tile: large, as that saves copies, but with a tile for every core."""
    for block in (1024, 512):
        if -(-n_rows // block) * -(-n_cols // block) >= cores:
            return block
    return 1024 if max(n_rows, n_cols) <= 1024 else 512


def costs(stats: ProductStats, shape: Shape, sums: float, broadcast_limit: int,
          cores: int) -> dict[str, float]:
    """What each plan should take, in seconds of one core. ``sums``: cells of the result.

    The cell plans pay for every product; where no side can be broadcast, the products are
    shuffled too. The kernel plans pay for shipping packed cells, to the parts that name them or
    to all groups of tiles, for products in the kernel, and for the cells that leave it.
    """
    if fits_broadcast(min(stats.nnz_a, stats.nnz_b), broadcast_limit):
        by_cell = stats.products * SECONDS_PER_PRODUCT + sums * SECONDS_PER_SUM
        found = {"broadcast": CELL_STAGES_SECONDS + by_cell}
    else:
        found = {"join": CELL_STAGES_SECONDS + stats.products * SECONDS_PER_SHUFFLED_PRODUCT}
    given = KERNEL_STAGES_SECONDS + sums * SECONDS_PER_GIVEN_CELL
    parts = number_of_parts(stats.products, sums, stats.nnz_a, cores)
    copies = min(stats.products, parts * stats.nnz_b)
    found["rows"] = (
        given + (stats.nnz_a + copies) * SECONDS_PER_SHIPPED_CELL + stats.products * SECONDS_PER_ROW_PAIR
    )
    tiles = shape.tiles()
    shipped = stats.nnz_a * tiles[2] + stats.nnz_b * tiles[0]
    edge = [min(shape.block, n) for n in (shape.n_rows, shape.n_inner, shape.n_cols)]
    dense = tiles[0] * tiles[1] * tiles[2] * 2.0 * edge[0] * edge[1] * edge[2] * SECONDS_PER_FLOP
    found["block"] = (
        given + shipped * SECONDS_PER_SHIPPED_CELL + min(dense, stats.products * SECONDS_PER_PAIR)
    )
    return found


def choose_strategy(stats: ProductStats, n_rows: int, n_inner: int, n_cols: int, block: int,
                    broadcast_limit: int = BROADCAST_LIMIT_BYTES, cores: int = 8,
                    sums: Callable[[], float] | None = None) -> str:
    """``broadcast``, ``join``, ``rows`` or ``block``, whichever should take the least time.

    The number of cells of the result lies between the products over the inner size and the
    lesser of products and area; it is guessed as if cells lay anywhere. Where the choice hangs on it
    and an estimate costs little beside the product, ``sums`` is asked for one.
    """
    shape = Shape(n_rows, n_inner, n_cols, block)
    area = n_rows * n_cols
    most = float(min(area, stats.products))
    least = min(most, stats.products / max(1, n_inner))
    guess = min(most, max(least, -area * math.expm1(-stats.products / max(1, area))))

    def cheapest(at: float) -> str:
        found = costs(stats, shape, at, broadcast_limit, cores)
        return min(found, key=found.get)

    cost = min(costs(stats, shape, guess, broadcast_limit, cores).values())
    worth = (stats.nnz_a + stats.nnz_b) * SECONDS_PER_SKETCHED_CELL <= WORTH * cost
    if sums is None or not worth or cheapest(least) == cheapest(most):
        return cheapest(guess)
    return cheapest(min(most, max(least, sums())))
