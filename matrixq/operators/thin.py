"""Dense rows times a thin matrix."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matrixq.functions import cell_products, tile_kernel
from matrixq.functions.cell_products import ByInner
from matrixq.functions.tile_kernel import add_whole
from matrixq.model import Matrix, value_type_of, within_shape
from matrixq.operators.cells import coalesce_cells
from matrixq.operators.product import check_conformable, matmul
from matrixq.plans.limits import DENSE_FACTOR_LIMIT

cloudpickle.register_pickle_by_value(tile_kernel)
cloudpickle.register_pickle_by_value(cell_products)

# Cells a task hands back at a time.
OUTPUT_BATCH = 1_000_000


def dense_rows_matmul(rows: DataFrame, b: Matrix, *, i: str = "i", vals: str = "vals",
                      n_rows: int | None = None) -> Matrix:
    """Rows ``(i, vals)``, one per ``i``, times ``B``: the cells that ``matmul`` gives, whole
    numbers if both factors are whole, zeros kept in every column in which ``B`` has a cell.

    Each row is whole in its record, so nothing is shuffled: every task multiplies its rows by
    a copy of ``B``. That copy is taken only where the declared shape of ``B`` bounds it to
    ``DENSE_FACTOR_LIMIT`` values; any larger ``B`` goes through ``matmul`` on cells, with the
    same result. A row of another length than ``B`` has rows fails the job.
    Reading the copy runs one job.
    """
    from matrixq.operators.convert import from_dense_rows

    packed = rows.select(F.col(i).cast("bigint").alias("i"), F.col(vals).alias("vals"))
    if b.n_rows is not None:
        found = F.concat_ws(" ", F.lit(f"expected {b.n_rows} values in row"), F.col("i"),
                            F.lit("and found"), F.size("vals"))
        even = F.when(F.size("vals") == b.n_rows, F.lit(True)).otherwise(F.raise_error(found))
        packed = packed.where(even.cast("boolean"))
    left = from_dense_rows(packed, n_rows, b.n_rows)
    if b.n_rows is None or b.n_cols is None or b.n_rows * b.n_cols > DENSE_FACTOR_LIMIT:
        return matmul(left, b)
    check_conformable(left, b)
    value_type = value_type_of(left, b)
    whole = value_type == "bigint"
    factor = np.zeros((b.n_rows, b.n_cols), np.int64 if whole else np.float64)
    cells = coalesce_cells(within_shape(b)).cells
    cells = cells.select("i", "j", F.col("v").cast(value_type)).toArrow()
    k, j, v = (cells[c].to_numpy() for c in ("i", "j", "v"))
    factor[k, j] = v
    # A column without a cell has no products; the others have one for every row.
    held, column = np.unique(j, return_inverse=True)
    factor = factor[:, held]
    step = max(1, OUTPUT_BATCH // max(1, len(held)))
    finite = whole or bool(np.isfinite(v).all())

    def stored_only(dense: np.ndarray, out: np.ndarray) -> None:
        """Pairs of stored cells alone, so that an absent cell never meets an infinity."""
        row, inner = np.divmod(np.arange(dense.size), dense.shape[1])
        for col, r, x, y in ByInner(column, k, v).products(inner, row, dense.ravel()):
            np.add.at(out, (r, col), x * y)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows if len(held) else 0, step):
                part = batch.slice(start, step)
                flat = part.column("vals").flatten().to_numpy(zero_copy_only=False)
                dense = flat.reshape(part.num_rows, len(factor))
                out = np.zeros((part.num_rows, len(held)), factor.dtype)
                if whole:
                    add_whole(dense, factor, out)
                elif finite and np.isfinite(dense).all():
                    out += dense @ factor
                else:
                    stored_only(dense, out)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(part.column("i").to_numpy(), len(held))),
                        pa.array(np.tile(held, part.num_rows)),
                        pa.array(out.ravel()),
                    ],
                    names=["i", "j", "v"],
                )

    typed = packed.select("i", F.col("vals").cast(T.ArrayType(T.LongType() if whole else T.DoubleType())))
    cells_out = typed.mapInArrow(multiply, f"i bigint, j bigint, v {value_type}")
    return Matrix(cells_out, n_rows, b.n_cols, unique=True)
