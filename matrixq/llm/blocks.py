"""Searches of many query vectors among all vectors, block by block.

Vectors are dealt into blocks of bounded size and the queries into chunks; every block meets every
chunk in one task, which builds its index of the block and returns the best rows of the block for
each query. The best rows over all blocks are the result. Blocks are dealt by place, not by value
or id, so equal vectors or ids spread evenly.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matrixq.llm.common import written

#: Components in a block (at 64 components 16,384 vectors), and queries in a chunk.
BLOCK_VALUES, CHUNK_QUERIES = 1 << 20, 16_384


def finite(vector: Column) -> Column:
    """Whether the vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def matrix(table: pa.Table, name: str, width: int, kind: str) -> np.ndarray:
    """The vectors as rows of a matrix; shorter ones are filled up with zeros."""
    column = table[name].combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    values = column.flatten().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), kind)
    if len(values) == out.size:
        out[:] = values.reshape(out.shape)
    else:
        out[np.arange(width) < sizes[:, None]] = values
    return out


def search(vectors: DataFrame, is_query: Column, k: int, kind: str,
           kernel: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple]) -> DataFrame:
    """Rows ``(query_id, rank, vec_id, score)`` from rows ``(vec_id, vector)``.

    ``kernel`` gets the ids and vectors of a block and of a chunk of queries, and returns query
    ids, row ids and scores of at least the ``k`` best rows of the block for each query. Scores
    are ``kind`` (``int64`` or ``float64``).
    """
    placed = written(vectors.withColumn("place", F.monotonically_increasing_id()), "vectors")
    seen = placed.agg(
        F.count("*").alias("rows"), F.max(F.size("vector")).alias("width"),
        F.sum(is_query.cast("long")).alias("queries"),
    ).first()
    width = max(1, seen["width"] or 1)
    rows = max(256, BLOCK_VALUES // width)
    blocks = max(1, -(-seen["rows"] // rows))
    chunks = max(1, -(-(seen["queries"] or 0) // CHUNK_QUERIES))
    place = F.xxhash64("place")
    block, chunk = F.pmod(place, F.lit(blocks)), F.pmod(place, F.lit(chunks))
    each_chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    each_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    held = placed.select("vec_id", "vector", block.cast("int").alias("block"), each_chunk.alias("chunk"))
    asked = placed.where(is_query).select(
        "vec_id", "vector", chunk.cast("int").alias("chunk"), each_block.alias("block")
    )
    score_type = "long" if kind == "int64" else "double"
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()),
                        ("score", pa.int64() if kind == "int64" else pa.float64())])

    def meet(some: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(some) or not len(queries):
            return schema.empty_table()
        found = kernel(
            some["vec_id"].to_numpy(), matrix(some, "vector", width, kind),
            queries["vec_id"].to_numpy(), matrix(queries, "vector", width, kind),
        )
        return pa.table(dict(zip(schema.names, found)), schema=schema)

    near = held.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInArrow(
        meet, f"query_id long, vec_id long, score {score_type}"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
