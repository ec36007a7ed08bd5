"""The kernel of the row-wise product, and the packing of what it reads."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from matrixq.functions.cell_products import AT_A_TIME, ByInner, Sums

#: Cells a task packs at a time, and cells of the result it gives out at a time.
PACKED, GIVEN = 1 << 18, 1 << 20
#: Output cells of a part that are summed up in an array with a place for each.
DENSE_SUMS = 1 << 24

# What a record holds: left cells, those of a row of the right factor by the sizes of its gaps and
# values, cells of the right factor, or pairs of cells that meet. The last part of a record's key.
LEFT, ROW, CELLS, PAIRS, KINDS = 0, 1, 17, 18, 32
GAPS = [np.dtype(t) for t in (np.uint8, np.uint16, np.uint32, np.int64)]
VALUES = [np.dtype(t) for t in (np.int8, np.int16, np.int32, np.int64)]


def pack(whole: bool, values: tuple[str, ...] = ("v",)):
    """Packs cells ``(key, x, k, *values)`` as they come into records ``(key, x, v)``: bytes of the
    pairs ``(x, k)`` and of the values of each cell."""
    kind = np.int64 if whole else np.float64
    names = ["key", "x", "k", *values]

    def packed(key: np.ndarray, x: np.ndarray, k: np.ndarray, *v: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(key, kind="stable")
        key = key[order]
        cut = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
        places, held = np.stack([x, k], 1)[order], np.stack(v, 1)[order]
        return pa.RecordBatch.from_arrays(
            [pa.array(key[cut]), _binary(places, cut), _binary(held, cut)], names=["key", "x", "v"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _gathered(batches, names, values, kind):
            yield packed(*columns)

    return run


def pack_rows(whole: bool, wide: bool):
    """Packs cells ``(k, x, v)``, sorted by the first two, into records ``(k, kind, x, v)`` of a row's
    cells each: ``x`` holds ``k``, the first column and the gaps between the columns, ``v`` the values,
    either in the narrowest type that holds all of the row. ``wide``: indexes may leave 32 bits."""
    as_read = np.int64 if whole else np.float64
    head = np.dtype(np.int64 if wide else np.int32)

    def packed(k: np.ndarray, x: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        gaps = np.diff(x, prepend=x[0])
        cut = np.flatnonzero((np.diff(k, prepend=k[0] - 1) != 0) | (gaps < 0))
        gaps[cut] = 0
        most = np.maximum.reduceat(gaps, cut)
        size = np.searchsorted([1 << 8, 1 << 16, 1 << 32], most, "right")
        held = np.full(len(cut), 3)
        if whole:
            held[:] = 0
            least, largest = np.minimum.reduceat(v, cut), np.maximum.reduceat(v, cut)
            for t in VALUES[:3]:
                held += (least < np.iinfo(t).min) | (largest > np.iinfo(t).max)
        heads = np.stack([k[cut], x[cut]], 1).astype(head).tobytes()
        as_gaps = [gaps.astype(t).tobytes() if (size == n).any() else b"" for n, t in enumerate(GAPS)]
        as_values = [v.astype(t).tobytes() if (held == n).any() else b"" for n, t in enumerate(
            VALUES if whole else [*VALUES[:3], np.dtype(np.float64)])]
        ends, row = [*cut[1:].tolist(), len(k)], 2 * head.itemsize
        placed, values = [], []
        for r, (start, stop, g, t) in enumerate(zip(cut.tolist(), ends, size.tolist(), held.tolist())):
            wide_gap, wide_value = GAPS[g].itemsize, VALUES[t].itemsize
            placed.append(heads[r * row:(r + 1) * row] + as_gaps[g][start * wide_gap:stop * wide_gap])
            values.append(as_values[t][start * wide_value:stop * wide_value])
        return pa.RecordBatch.from_arrays([
            pa.array(k[cut]), pa.array((ROW + 4 * size + held).astype(np.int64)),
            pa.array(placed, pa.binary()), pa.array(values, pa.binary()),
        ], names=["k", "kind", "x", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _gathered(batches, ["k", "x", "v"], ("v",), as_read):
            yield packed(*columns)

    return run


def _gathered(batches: Iterator[pa.RecordBatch], names: list[str], values: tuple[str, ...], kind
              ) -> Iterator[list[np.ndarray]]:
    """Columns of ``PACKED`` cells or a little more at a time."""
    held: list[list[np.ndarray]] = [[] for _ in names]
    cells = 0
    for batch in batches:
        for column, name in zip(held, names):
            column.append(batch.column(name).to_numpy().astype(kind if name in values else np.int64))
        cells += batch.num_rows
        if cells >= PACKED:
            yield [np.concatenate(c) for c in held]
            held, cells = [[] for _ in names], 0
    if cells:
        yield [np.concatenate(c) for c in held]


def _binary(lines: np.ndarray, cut: np.ndarray) -> pa.Array:
    """The bytes of an array's lines, cut into values."""
    ends = (np.append(cut, len(lines)) * lines.shape[1] * lines.itemsize).astype(np.int32)
    buffers = [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(np.ascontiguousarray(lines).tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(cut), buffers)


def row_sums(width: int, buckets: int, whole: bool, wide: bool):
    """The kernel: the records of a part come in by bucket of inner indexes, the left factor's
    first; the cells of finished parts go out.

    The left cells of one bucket are held, the right ones stream past, and the part's sums are
    held until it is done. A record's key is its part, bucket and kind. ``width``: columns of the
    result. ``wide``: as in ``pack_rows``.
    """
    kind = np.dtype(np.int64 if whole else np.float64)
    head = np.dtype(np.int64 if wide else np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = _Part(-1, width, buckets, whole)
        at = None
        for batch in batches:
            keys = batch.column("key").to_numpy()
            cuts = np.flatnonzero(np.diff(keys, prepend=-1)).tolist()
            for start, stop in zip(cuts, [*cuts[1:], len(keys)]):
                place, side = divmod(int(keys[start]), KINDS)
                number, bucket = divmod(place, buckets)
                if (number, bucket) != at:
                    if number != part.number:
                        yield from part.cells()
                        part = _Part(number, width, buckets, whole)
                    part.open_bucket()
                    at = number, bucket
                if side == PAIRS:
                    places, values = (_flat(batch, c, start, stop, t)[0].reshape(-1, 2) for c, t in (("x", np.dtype(np.int64)), ("v", kind)))
                    part.add_pairs(places[:, 1], places[:, 0], values[:, 0], values[:, 1])
                elif side in (LEFT, CELLS):
                    places = _flat(batch, "x", start, stop, np.dtype(np.int64))[0].reshape(-1, 2)
                    v, _ = _flat(batch, "v", start, stop, kind)
                    (part.hold if side == LEFT else part.multiply)(places[:, 0], places[:, 1], v)
                else:
                    size, held = divmod(side - ROW, 4)
                    k, x = _places(batch, start, stop, GAPS[size], head)
                    v, _ = _flat(batch, "v", start, stop, kind if held == 3 else VALUES[held])
                    part.multiply(x, k, v.astype(kind, copy=False))
        yield from part.cells()

    return run


def _flat(batch: pa.RecordBatch, column: str, start: int, stop: int, t: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some records in a row as numbers, and how many each has."""
    values = batch.column(column)
    _, ends, data = values.buffers()
    ends = np.frombuffer(ends, np.int32, stop - start + 1, 4 * (values.offset + start))
    if data is None or ends[-1] == ends[0]:
        return np.zeros(0, t), np.diff(ends) // t.itemsize
    numbers = np.frombuffer(data, t, (ends[-1] - ends[0]) // t.itemsize, ends[0])
    return numbers, np.diff(ends) // t.itemsize


def _places(batch: pa.RecordBatch, start: int, stop: int, gap: np.dtype, head: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Inner index and column of each cell of some rows that ``pack_rows`` has packed."""
    units, counts = _flat(batch, "x", start, stop, gap)
    width = 2 * head.itemsize // gap.itemsize
    at = ((np.cumsum(counts) - counts)[:, None] + np.arange(width)).reshape(-1)
    heads = units[at].view(head).reshape(-1, 2).astype(np.int64)
    within = np.ones(len(units), bool)
    within[at] = False
    n = counts - width
    run = np.cumsum(units[within].astype(np.int64))
    return np.repeat(heads[:, 0], n), run + np.repeat(heads[:, 1] - run[np.cumsum(n) - n], n)


class _Part:
    def __init__(self, number: int, width: int, buckets: int, whole: bool) -> None:
        self.number, self.width, self.buckets, self.whole = number, width, buckets, whole
        self.code: dict[int, int] = {}  # place of each row among those of the part
        self.rows: list[int] = []
        self.sums: Sums | None = None
        self.open_bucket()

    def open_bucket(self) -> None:
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.left: ByInner | None = None

    def hold(self, i: np.ndarray, k: np.ndarray, v: np.ndarray) -> None:
        self.held.append((i, k, v))

    def multiply(self, j: np.ndarray, k: np.ndarray, v: np.ndarray) -> None:
        if self.left is None:
            if not self.held:
                return
            i, inner, values = (np.concatenate(x) for x in zip(*self.held))
            self.left = ByInner(self.lines(i), inner, values)
            self.held = []
            if self.sums is None:
                # With further buckets further rows may come, so there is no array for all.
                dense = DENSE_SUMS if self.buckets == 1 else 0
                self.sums = Sums(len(self.rows) * self.width, self.whole, dense)
        for line, col, x, y in self.left.products(k, j, v):
            self.sums.add(line * self.width + col, x, y)

    def lines(self, i: np.ndarray) -> np.ndarray:
        """The place of each row among those of the part."""
        found, of = np.unique(i, return_inverse=True)
        for row in found.tolist():
            if row not in self.code:
                self.code[row] = len(self.rows)
                self.rows.append(row)
        return np.array([self.code[row] for row in found.tolist()], np.int64)[of]

    def add_pairs(self, i: np.ndarray, j: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        if self.sums is None:
            self.sums = Sums(0, self.whole, -1)
        line = self.lines(i)
        for start in range(0, len(i), AT_A_TIME):
            of = slice(start, start + AT_A_TIME)
            self.sums.add(line[of] * self.width + j[of], x[of], y[of])

    def cells(self) -> Iterator[pa.RecordBatch]:
        if self.sums is None:
            return
        keys, values = self.sums.result()
        rows = np.array(self.rows, np.int64)
        for start in range(0, len(keys), GIVEN):
            row, col = np.divmod(keys[start:start + GIVEN], self.width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[row]), pa.array(col), pa.array(values[start:start + GIVEN])],
                names=["i", "j", "v"],
            )
