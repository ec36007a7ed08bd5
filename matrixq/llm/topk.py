"""Exact top-k search by inner product over an impact-ordered index, score at a time.

The components of a block of vectors are the postings of 64 or so terms, the vector's places. Each
term's postings are cut into segments by quantised value; the impact of a segment for a query is
the most it can add to a score, above the least that any posting of its term adds. Segments are
worked off by descending impact, whatever their term, and add their impact to the scores of their
rows. A row's score then lies between what it has, less the widths of the segments, and what it
has plus the greatest impact left in each term where it has not been met.

Work stops only on proof: when few rows can still reach the k-th best lower bound, or when all
segments are done. All rows that can reach it are scored exactly, so the result is exact wherever
the work stops.

Vectors that are null or hold a null or a number that is not finite take no part, nor do rows
without id. Rows with the query's own id are no candidates for it; apart from that repeated rows
each count. Ties go to the smaller id. Where products or sums might pass 64 bits they are formed in
whole numbers of any size; a score that is returned and passes 64 bits is an error, as is a
component that does.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matrixq.llm import blocks

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(blocks)

#: Quantised values of a term.
LEVELS = 64
#: Shares of the postings after which the proof is tried.
TRIALS = (0.5, 0.7, 0.85, 1.0)
#: Rows that may be left for exact scoring when work stops early, as a share of the block.
LEFT = 1 / 64


class ImpactIndex:
    """The segments of a block's postings."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.largest = float(np.abs(vectors.astype(np.float64)).max(initial=0.0))
        n, width = vectors.shape
        least, most = vectors.min(0), vectors.max(0)
        step = (most - least) // LEVELS + 1
        self.level = ((vectors - least) // step).astype(np.int8)
        order = np.argsort(self.level, axis=0, kind="stable")
        levels = np.take_along_axis(self.level, order, 0).T.ravel()
        values = np.take_along_axis(vectors, order, 0).T.ravel()
        self.rows = order.T.ravel()  # all postings, term by term, by level
        terms = np.repeat(np.arange(width), n)
        self.begin = np.flatnonzero(np.diff(levels.astype(np.int64) + terms * LEVELS, prepend=-1))
        self.sizes = np.diff(self.begin, append=len(levels))
        self.term = terms[self.begin]
        self.low = np.minimum.reduceat(values, self.begin)
        self.high = np.maximum.reduceat(values, self.begin)
        self.of_level = np.full((width, LEVELS), -1)
        self.of_level[self.term, levels[self.begin]] = np.arange(len(self.begin))
        self.first = np.flatnonzero(np.diff(self.term, prepend=-1))

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows, other than those with the query's id."""
        free = np.flatnonzero(self.ids != query_id)
        if len(free) > k:
            free = self.possible(query, k, free)
        ids = self.ids[free]
        if self.fits(query):
            scores = self.vectors[free] @ query
            order = np.lexsort((ids, -scores))[:k]
            return ids[order], scores[order]
        scores = self.vectors[free].astype(object) @ query.astype(object)
        order = sorted(range(len(ids)), key=lambda r: (-scores[r], ids[r]))[:k]
        if any(not -(1 << 63) <= scores[r] < 1 << 63 for r in order):
            raise OverflowError("a score passes 64 bits")
        return ids[order], scores[order].astype(np.int64)

    def fits(self, query: np.ndarray) -> bool:
        """Whether no sum of products can pass 64 bits."""
        most = np.abs(query.astype(np.float64)).max(initial=0.0) * self.largest
        return most * len(query) < 2.0**62

    def add(self, score: np.ndarray, segments: np.ndarray, impact: np.ndarray) -> None:
        """Adds the impacts of some segments to the scores of their rows."""
        sizes = self.sizes[segments]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(self.begin[segments] - ends + sizes, sizes)
        score += np.bincount(
            self.rows[places], np.repeat(impact[segments], sizes), minlength=len(score)
        )

    def possible(self, query: np.ndarray, k: int, free: np.ndarray) -> np.ndarray:
        """The rows of ``free`` that may be among its k best."""
        # Beyond 64 bits bounds are doubles; their rounding is part of the slack.
        weight = query[self.term].astype(np.int64 if self.fits(query) else np.float64)
        ends = weight * self.low, weight * self.high
        top, bottom = np.maximum(*ends), np.minimum(*ends)
        floor = np.minimum.reduceat(bottom, self.first)[self.term]
        impact = (top - floor).astype(np.float64)
        total = float(np.maximum.reduceat(impact, self.first).sum())
        # What a row has may be too much by the widths of its segments, and by rounding.
        slack = float(np.maximum.reduceat(top - bottom, self.first).sum()) + 1e-9 * total
        order = np.argsort(-impact, kind="stable")
        posted = np.cumsum(self.sizes[order])
        trials = np.searchsorted(posted, np.array(TRIALS) * posted[-1])
        score = np.zeros(len(self.ids))
        done, limit = 0, max(4 * k, int(len(free) * LEFT))
        pending = impact.copy()
        for stop in np.minimum(trials, len(order) - 1) + 1:
            if stop == done:
                continue
            self.add(score, order[done:stop], impact)
            pending[order[done:stop]] = -1
            done = stop
            rest = np.maximum(np.maximum.reduceat(pending, self.first), 0)
            reached = score[free]
            bound = np.partition(reached, len(reached) - k)[len(reached) - k] - slack
            near = free[reached + rest.sum() >= bound]
            if limit < len(near) <= 8 * limit and done < len(order):
                # What a row can still gain, term by term: nothing where it has been met.
                gain = np.where(pending[self.of_level] >= 0, rest[:, None], 0)
                more = gain[np.arange(len(rest)), self.level[near]].sum(1)
                near = near[score[near] + more >= bound]
            if len(near) <= limit or done == len(order):
                return near
        return free


def search(df: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding",
           k: int = 10, scale: int = 1024) -> DataFrame:
    """Rows ``(query_id, rank, vec_id, score)``: for each row that ``is_query`` (a condition on
    ``vec_id``) its ``k`` best others by the integer inner product of ``floor(scale * x)``."""
    source = F.col(f"`{vector}`")
    too_large = F.raise_error(F.lit(f"a component times {scale} passes 64 bits"))

    def quantised(x: Column) -> Column:
        scaled = F.floor(F.lit(float(scale)) * x.cast("double"))
        fits = F.abs(F.lit(float(scale)) * x.cast("double")) < F.lit(float(1 << 62))
        return F.when(fits, scaled.cast("long")).otherwise(too_large.cast("long"))

    whole = F.transform(source, quantised)
    rows = df.where(F.col(f"`{vec_id}`").isNotNull() & blocks.finite(source)).select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), whole.alias("vector")
    )

    def kernel(ids, vectors, query_ids, queries):
        index = ImpactIndex(ids, vectors)
        found = [index.best(q, v, k) for q, v in zip(query_ids.tolist(), queries)]
        return (np.repeat(query_ids, [len(i) for i, _ in found]),
                np.concatenate([i for i, _ in found]), np.concatenate([s for _, s in found]))

    return blocks.search(rows, is_query, k, "int64", kernel)
