"""Size bounds that decide whether a side may be broadcast or gathered."""

from __future__ import annotations

# What one cell takes in a broadcast hash table, key, row and slack together.
BROADCAST_ROW_BYTES = 64
# A broadcast side may take this much on every executor.
BROADCAST_LIMIT_BYTES = 128 * 1024 * 1024
# A dense right factor sent to the workers as an array may have this many values.
DENSE_FACTOR_LIMIT = 4_000_000
# A dense row or block held in one record may have this many values.
DENSE_RECORD_LIMIT = 2_000_000


def fits_broadcast(rows: int, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> bool:
    return rows * BROADCAST_ROW_BYTES <= limit_bytes


# A task of a product should form about this many cell pairs.
PRODUCTS_PER_TASK = 2_000_000
# A task that reads shuffled cells should get about this many, some 100 MB.
CELLS_PER_TASK = 4_000_000
# From this many products per cell on, a join is sized by its products instead of its bytes.
EXPANDING_FROM = 4
# No shuffle is asked to have more partitions than this.
MAX_PARTITIONS = 32_768
# What a part of the row-wise product may have: products to form, sums to hold (8 MB, which stay in
# a core's cache), left cells to hold.
PART_PRODUCTS, PART_SUMS, PART_CELLS = 1 << 25, 1 << 20, 1 << 21


def number_of_parts(products: int, sums: float, cells: int, cores: int,
                    part_products: int = PART_PRODUCTS) -> int:
    """Parts of a row-wise product: as many as the bounds ask for, and enough for all cores where
    there is work for them."""
    wanted = max(
        -(-products // part_products), -(-int(sums) // PART_SUMS), -(-cells // PART_CELLS),
        min(2 * cores, -(-products // (1 << 20))), 1,
    )
    return min(MAX_PARTITIONS, wanted)
