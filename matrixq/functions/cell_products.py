"""Products of stored cells, formed in batches that fit in memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Products formed at a time: some 30 MB.
AT_A_TIME = 1 << 20


class ByInner:
    """Cells ``(line, k, v)`` of a left factor, held by their inner index."""

    def __init__(self, line: np.ndarray, k: np.ndarray, v: np.ndarray) -> None:
        order = np.argsort(k, kind="stable")
        self.line, self.v = line[order], v[order]
        self.keys, self.start, self.count = np.unique(
            k[order], return_index=True, return_counts=True
        )

    def counts(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in ``keys`` and number of cells with each inner index."""
        if not len(self.keys):
            return np.zeros(len(k), np.int64), np.zeros(len(k), np.int64)
        at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return at, np.where(self.keys[at] == k, self.count[at], 0)

    def products(self, k: np.ndarray, j: np.ndarray, v: np.ndarray
                 ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For cells ``(k, j, v)`` of a right factor: the lines, columns and both values of each
        pair of cells that meet."""
        at, counts = self.counts(k)
        met = np.flatnonzero(counts)
        at, counts, j, v = at[met], counts[met], j[met], v[met]
        ends = np.cumsum(counts)
        first = 0
        while first < len(met):
            done = ends[first - 1] if first else 0
            stop = max(first + 1, int(np.searchsorted(ends, done + AT_A_TIME, "right")))
            n = counts[first:stop]
            # Where one cell alone meets more than a batch, its partners go in slices.
            for low in range(0, int(n.sum()), AT_A_TIME) if stop == first + 1 else (0,):
                if stop == first + 1:
                    rows = np.arange(low, min(low + AT_A_TIME, int(n[0])))
                    right = np.zeros(len(rows), np.int64)
                    left = self.start[at[first]] + rows
                else:
                    right = np.repeat(np.arange(len(n)), n)
                    behind = np.arange(len(right)) - np.repeat(np.cumsum(n) - n, n)
                    left = self.start[at[first:stop]][right] + behind
                yield self.line[left], j[first:stop][right], self.v[left], v[first:stop][right]
            first = stop


class ByOffset(ByInner):
    """The same where inner indexes are offsets below ``width``: a place for each, no search."""

    def __init__(self, line: np.ndarray, k: np.ndarray, v: np.ndarray, width: int) -> None:
        order = np.argsort(k, kind="stable")
        self.line, self.v = line[order], v[order]
        self.count = np.bincount(k, minlength=width)
        self.start = np.cumsum(self.count) - self.count

    def counts(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return k, self.count[k]


def whole_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact products of whole numbers: in 64 bits where they fit, else of any size."""
    if len(x) and float(np.abs(x.astype(np.float64)).max()) * float(np.abs(y.astype(np.float64)).max()) >= 2.0**62:
        return x.astype(object) * y.astype(object)
    return x * y


def checked(total: np.ndarray) -> np.ndarray:
    """Whole numbers of any size as 64-bit ones; one that does not fit is an error."""
    if len(total) and (total.max() >= 2**63 or total.min() < -(2**63)):
        raise OverflowError("a sum of whole numbers leaves the 64-bit range")
    return total.astype(np.int64)


class Sums:
    """Sums by key, of doubles or of whole numbers, which are exact.

    Up to ``dense`` keys are held as an array with a place for each possible key, others as
    sorted runs that are merged when they double what is held.
    """

    def __init__(self, keys: int, whole: bool, dense: int) -> None:
        self.whole = whole
        self.dtype = np.int64 if whole else np.float64
        self.table = np.zeros(keys, self.dtype) if keys <= dense else None
        self.met = np.zeros(keys, bool) if keys <= dense else None
        self.bound = 0.0  # no sum so far is larger
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = self.pending = 0

    def add(self, key: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        if not len(key):
            return
        values = whole_products(x, y) if self.whole else x * y
        if self.whole and values.dtype != object:
            self.bound += float(np.abs(values.astype(np.float64)).max()) * len(values)
        if self.table is not None:
            self._add_dense(key, values)
            return
        if self.whole:
            values = values.astype(object) if self.bound >= 2.0**62 else values
        self.runs.append(_merged(key, values))
        self.pending += len(self.runs[-1][0])
        if self.pending > max(AT_A_TIME, self.held):
            self._merge()

    def _add_dense(self, key: np.ndarray, values: np.ndarray) -> None:
        self.met[key] = True
        if self.whole and (values.dtype == object or self.bound >= 2.0**62):
            if self.table.dtype != object:
                self.table = self.table.astype(object)
            values = values.astype(object)
        np.add.at(self.table, key, values)

    def _merge(self) -> None:
        keys, values = (np.concatenate(x) for x in zip(*self.runs))
        self.runs = [_merged(keys, values)]
        self.held, self.pending = len(self.runs[0][0]), 0

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys that some product went into, in order, and their sums."""
        if self.table is not None:
            keys = np.flatnonzero(self.met)
            values = self.table[keys]
        elif self.runs:
            self._merge()
            keys, values = self.runs[0]
        else:
            return np.zeros(0, np.int64), np.zeros(0, self.dtype)
        return keys, checked(values) if values.dtype == object else values


def _merged(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    runs = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    return keys[runs], np.add.reduceat(values, runs)
