"""Connected components of a graph given by its links, as rounds of joins and minima."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixq.llm.common import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Nodes whose links are joined at a time inside of a task.
LOCAL_NODES = 500_000


def _joined_locally(links: DataFrame) -> DataFrame:
    """Links of the same components: of the links that a task reads together, each node is linked
    to the smallest node it hangs together with there. Long chains shrink before any shuffle."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict = {}

        def top(x):
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        def flush() -> pa.RecordBatch:
            nodes = [x for x in up if up[x] != x]
            return pa.RecordBatch.from_arrays(
                [pa.array(nodes, schema.field("a").type),
                 pa.array([top(x) for x in nodes], schema.field("b").type)], ["a", "b"],
            )

        schema = None
        for batch in batches:
            schema = batch.schema
            for x, y in zip(batch["a"].to_pylist(), batch["b"].to_pylist()):
                up.setdefault(x, x)
                up.setdefault(y, y)
                x, y = top(x), top(y)
                if x < y:
                    up[y] = x
                else:
                    up[x] = y
            if len(up) >= LOCAL_NODES:
                yield flush()
                up = {}
        if schema is not None:
            yield flush()

    return links.mapInArrow(join, links.schema)


def components(links: DataFrame) -> DataFrame:
    """Rows ``(node, component)`` for all nodes of the links ``(a, b)`` to other nodes; a component
    is named by its smallest node.

    Links are joined inside of tasks first. Then large-star and small-star rounds alternate: every
    node hangs its larger neighbours, then its smaller ones, below the smallest node it knows.
    Rounds are few, as distances shrink with each, and no round makes more links than there were.
    They end when every node but the smallest of each component has that one as its only link.
    Minima are combined before they are shuffled, and a node with very many links is split by
    adaptive execution where links are joined.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = written(_joined_locally(written(links, "links")).distinct(), "links")
    while not _all_stars(links):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        hung = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        hung = written(hung, "links")
        least = hung.groupBy("a").agg(F.min("b").alias("m"))
        down = hung.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = written(
            down.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links"
        )
    tops = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(tops)


def _all_stars(links: DataFrame) -> bool:
    """Whether no node has two links down, or one down and one up."""
    down = links.select(F.col("a").alias("node"), F.lit(1).alias("down"))
    up = links.select(F.col("b").alias("node"), F.lit(None).cast("int").alias("down"))
    sums = down.unionByName(up).groupBy("node").agg(
        F.count("down").alias("down"), F.count_if(F.col("down").isNull()).alias("up")
    )
    return not sums.where("down > 1 or (down = 1 and up > 0)").limit(1).count()
