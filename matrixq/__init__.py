"""Distributed sparse and dense matrix operations on Spark DataFrames of cells."""

from matrixq.model import Matrix
from matrixq.operators.aggregates import (
    column_map,
    column_sums,
    distinct_indexes,
    index_range,
    infer_dims,
    info,
    is_empty,
    nnz,
    row_sums,
    total,
)
from matrixq.operators.cells import (
    coalesce_cells,
    drop_zeros,
    keep_matching_columns,
    scale_columns,
    transpose,
)
from matrixq.operators.convert import (
    from_blocks,
    from_dense_rows,
    to_blocks,
    to_dense_rows,
)
from matrixq.operators.gram import gram
from matrixq.operators.preview import preview, preview_table, sample
from matrixq.operators.product import (
    copartition,
    matmul,
    matvec,
    multiply_prepared,
    sum_of_product,
    vecmat,
)
from matrixq.operators.thin import dense_rows_matmul

__all__ = [
    "Matrix",
    "coalesce_cells",
    "column_map",
    "column_sums",
    "copartition",
    "dense_rows_matmul",
    "distinct_indexes",
    "drop_zeros",
    "from_blocks",
    "from_dense_rows",
    "gram",
    "index_range",
    "infer_dims",
    "info",
    "is_empty",
    "keep_matching_columns",
    "matmul",
    "matvec",
    "multiply_prepared",
    "nnz",
    "preview",
    "preview_table",
    "row_sums",
    "sample",
    "scale_columns",
    "sum_of_product",
    "to_blocks",
    "to_dense_rows",
    "total",
    "transpose",
    "vecmat",
]
