"""The kernel of the block product, run by each task over its sorted pieces of tiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from matrixq.functions.cell_products import ByInner, ByOffset, checked, whole_products

# Whole numbers below this are exact in a double.
EXACT = float(2**53)
GROUP_KEYS = ["gi", "gj", "layer", "bk"]
# What a product of two cells costs against one multiplication of the dense kernel.
CELL_COST = 500
# Products of positive numbers above this do not vanish.
TINIEST = 1e-290
# Cells that a task packs at a time, which is what a piece holds at the most.
PIECE = 1 << 20
# Right cells that meet the left ones of a step at a time.
STREAMED = 1 << 22
# Types of a piece's values, the narrowest that holds them.
VALUE_TYPES = [np.dtype(t) for t in (np.int8, np.int16, np.int32, np.int64, np.float64)]


def offset_type(extent: int) -> np.dtype:
    """The type of an offset below ``extent``."""
    return np.dtype(np.uint16 if extent <= 1 << 16 else np.int64)


def pieces_of_tiles(span: int, chunk: int, transposed: bool, whole: bool):
    """Packs cells ``(i, j, v)`` as they come into pieces ``(outer, inner, n, kind, data)``: ``n``
    cells of ``span`` output lines and ``chunk`` inner indexes. ``data`` is their offsets along the
    output, then along the inner index, then their values, whose type ``kind`` tells.
    ``transposed``: ``i`` is the inner index. Nothing is shuffled for it, so a place comes in as
    many pieces as tasks have cells of it."""
    as_read = np.int64 if whole else np.float64
    offsets = offset_type(span), offset_type(chunk)
    names = ["outer", "inner", "n", "kind", "data"]

    def narrowest(v: np.ndarray) -> int:
        least, most = int(v.min()), int(v.max())
        return next(t for t in range(4) if np.iinfo(VALUE_TYPES[t]).min <= least and most <= np.iinfo(VALUE_TYPES[t]).max)

    def packed(outer: np.ndarray, inner: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        at = np.stack([outer // span, inner // chunk])
        order = np.lexsort(at)
        at = at[:, order]
        cut = np.flatnonzero(np.any(np.diff(at, axis=1, prepend=-1), axis=0))
        across, along = ((x % size).astype(t)[order] for x, size, t in zip((outer, inner), (span, chunk), offsets))
        v = v[order]
        kinds, data = [], []
        for start, stop in zip(cut.tolist(), [*cut[1:].tolist(), len(order)]):
            values = v[start:stop]
            kinds.append(narrowest(values) if whole else 4)
            data.append(b"".join((
                across[start:stop].tobytes(), along[start:stop].tobytes(),
                values.astype(VALUE_TYPES[kinds[-1]]).tobytes(),
            )))
        counts = np.diff(np.append(cut, len(order)))
        return pa.RecordBatch.from_arrays([
            pa.array(at[0, cut]), pa.array(at[1, cut]), pa.array(counts.astype(np.int32)),
            pa.array(np.array(kinds, np.int32)), pa.array(data, pa.binary()),
        ], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], [], []]
        cells = 0
        for batch in batches:
            for column, c in zip(held, ("j", "i", "v") if transposed else ("i", "j", "v")):
                column.append(batch.column(c).to_numpy().astype(as_read if c == "v" else np.int64))
            cells += batch.num_rows
            if cells >= PIECE:
                yield packed(*map(np.concatenate, held))
                held, cells = [[], [], []], 0
        if cells:
            yield packed(*map(np.concatenate, held))

    return run


def unpacked(data: pa.Scalar, n: int, kind: int, offsets: tuple[np.dtype, np.dtype]) -> tuple[np.ndarray, ...]:
    """Offsets and values of a piece, as views of it."""
    buffer, at, out = data.as_buffer(), 0, []
    for t in (*offsets, VALUE_TYPES[kind]):
        out.append(np.frombuffer(buffer, t, n, at))
        at += n * t.itemsize
    return tuple(out)


class Tile:
    """The cells of a tile, and the tile as an array where that pays."""

    def __init__(self, outer: np.ndarray, inner: np.ndarray, val: np.ndarray) -> None:
        self.outer, self.inner, self.val = outer, inner, val
        self._array: np.ndarray | None = None
        self.finite = val.dtype != np.float64 or bool(np.isfinite(val).all())
        self.least = val.min()
        self.by_inner: ByInner | None = None

    def array(self, shape: tuple[int, int]) -> np.ndarray:
        if self._array is None:
            self._array = np.zeros(shape, self.val.dtype)
            self._array[self.outer, self.inner] = self.val
        return self._array

    def mask(self, shape: tuple[int, int]) -> np.ndarray:
        out = np.zeros(shape, np.float32)
        out[self.outer, self.inner] = 1
        return out

    def held(self) -> ByInner:
        if self.by_inner is None:
            self.by_inner = ByInner(self.outer, self.inner, self.val)
        return self.by_inner


class Output:
    """The tiles of a group in one array, with the places that some product went into."""

    def __init__(self, shape: tuple[int, int], whole: bool) -> None:
        self.sums = np.zeros(shape, np.int64 if whole else np.float64)
        self.met = np.zeros(shape, bool)
        self.bound = 0.0  # no whole sum so far is larger

    def add(self, left: Tile, right: Tile, row: int, col: int, edges: tuple[int, int, int]) -> None:
        """Adds the product of a left tile and a right one, whose ``outer`` are rows and columns,
        at ``row`` and ``col``. ``edges``: rows, inner size and columns of the tiles.

        Nearly empty tiles cost their pairs of cells, full ones the dense kernel. That kernel
        takes an absent cell for zero, so tiles that are not finite go cell by cell as well.
        """
        rows, inner, cols = edges
        _, counts = left.held().counts(right.inner)
        pairs = int(counts.sum())
        if not pairs:
            return
        if pairs * CELL_COST < rows * inner * cols or not (left.finite and right.finite):
            for line, j, x, y in left.held().products(right.inner, right.outer, right.val):
                self.add_pairs(line + row, j + col, x, y)
            return
        sums = self.sums[row:row + rows, col:col + cols]
        met = self.met[row:row + rows, col:col + cols]
        x, y = left.array((rows, inner)), right.array((cols, inner)).T
        if self.sums.dtype == np.int64:
            add_whole(x, y, sums)
            self.bound = max(self.bound, float(np.abs(sums.astype(np.float64)).max()))
        else:
            product = x @ y
            sums += product
        # Sums of positive products are positive, so they show where cells met.
        if self.sums.dtype != np.int64 and left.least > 0 and right.least > 0 and float(
                left.least) * float(right.least) > TINIEST:
            met |= product != 0
        else:
            met |= left.mask((rows, inner)) @ right.mask((cols, inner)).T > 0

    def add_pairs(self, i: np.ndarray, j: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        """Adds products of two cells each, formed one by one."""
        if not len(i):
            return
        key = i * self.sums.shape[1] + j
        flat, met = self.sums.reshape(-1), self.met.reshape(-1)
        met[key] = True
        if flat.dtype != np.int64:
            np.add.at(flat, key, x * y)
            return
        values = whole_products(x, y)
        most = float(np.abs(values.astype(np.float64)).max()) * len(values)
        if self.bound + most >= 2.0**62:
            self.bound = max(abs(float(flat.max())), abs(float(flat.min())))
        if values.dtype == object or self.bound + most >= 2.0**62:
            keys, of = np.unique(key, return_inverse=True)
            total = flat[keys].astype(object)
            np.add.at(total, of, values.astype(object))
            flat[keys] = checked(total)
            self.bound = max(abs(float(flat.max())), abs(float(flat.min())))
        else:
            np.add.at(flat, key, values)
            self.bound += most


def tile_sums(block: int, span: int, chunk: int, shape: tuple[int, int, int], whole: bool, symmetric: bool):
    """The kernel: pieces in the order of their groups come in, cells of finished groups go out.

    A group is ``span`` by ``span`` cells of the result, some tiles of ``block``. For each step
    along the inner index, ``chunk`` of it, the left cells are in memory, packed as they were sent,
    the right ones go past, and the group's sums are there throughout. A step in which few cells
    meet is multiplied cell by cell as a whole, others tile by tile. ``shape``: rows, inner size and
    columns of the matrices. ``symmetric``: a group on the diagonal gets the right pieces only,
    which are its left ones turned over, and cells below the diagonal are left out.
    """
    as_read = np.int64 if whole else np.float64
    offsets = offset_type(span), offset_type(chunk)
    edges = tuple(max(1, min(block, extent)) for extent in shape)
    rows, cols = (min(span, -(-max(1, shape[side]) // edges[side]) * edges[side]) for side in (0, 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step: _Step | None = None
        out: Output | None = None
        at = None
        for batch in batches:
            keys = np.stack(
                [batch.column(c).to_numpy() for c in (*GROUP_KEYS, "side", "n", "kind")], axis=1
            )
            data = batch.column("data")
            for r, (*key, side, n, kind) in enumerate(keys.tolist()):
                if key != at:
                    if at is not None:
                        out = _finish(step, out)
                        if key[:2] != at[:2]:
                            yield from _cells_of(out, at)
                            out = None
                    at, step = key, _Step(symmetric and key[0] == key[1])
                # Views of a batch would keep it whole.
                piece = tuple(x.copy() for x in unpacked(data[r], n, kind, offsets))
                step.pieces[side].append(piece)
                step.right += n if side else 0
                if step.right >= STREAMED and not step.diagonal:
                    out = _multiply(step, out)
        if at is not None:
            out = _finish(step, out)
            yield from _cells_of(out, at)

    def _finish(step: _Step, out: Output | None) -> Output | None:
        return _multiply(step, out) if step.pieces[1] else out

    def _multiply(step: _Step, out: Output | None) -> Output | None:
        """The right cells at hand with the left ones of the step."""
        right = [np.concatenate(x) for x in zip(*step.pieces[1])]
        step.pieces[1], step.right = [], 0
        if step.left is None:
            if not (step.pieces[0] or step.diagonal):
                return out
            step.left = right if step.diagonal else [np.concatenate(x) for x in zip(*step.pieces[0])]
            step.pieces[0] = []
        left = step.left
        pairs = np.bincount(left[1], minlength=chunk) * np.bincount(right[1], minlength=chunk)
        if not pairs.any():
            return out
        if out is None:
            out = Output((rows, cols), whole)
        by_tile = np.add.reduceat(pairs, np.arange(0, chunk, block))
        dense = by_tile * CELL_COST >= edges[0] * edges[1] * edges[2]
        if dense.any():
            left, right = (_parted(side, dense) for side in (left, right))
            for tile in np.flatnonzero(dense):
                _by_tile(left[1].get(tile, {}), right[1].get(tile, {}), step.diagonal, out)
            left, right = left[0], right[0]
        held = ByOffset(*left, chunk)
        for i, j, x, y in held.products(*(right[c] for c in (1, 0, 2))):
            i, j = i.astype(np.int64), j.astype(np.int64)
            x, y = x.astype(as_read), y.astype(as_read)
            if step.diagonal:
                kept = i <= j
                i, j, x, y = i[kept], j[kept], x[kept], y[kept]
            out.add_pairs(i, j, x, y)
        return out

    def _parted(side: list[np.ndarray], dense: np.ndarray) -> tuple[list, dict]:
        """The cells of inner tiles that are not dense, and those of the others by inner and
        outer tile."""
        tile = side[1].astype(np.int64) // block
        within = dense[tile]
        rest = [x[~within] for x in side]
        outer, inner, v = (x[within].astype(as_read if c == 2 else np.int64) for c, x in enumerate(side))
        places = np.stack([outer // block, inner // block])
        order = np.lexsort(places)
        places, outer, inner, v = places[:, order], outer[order] % block, inner[order] % block, v[order]
        cut = np.flatnonzero(np.any(np.diff(places, axis=1, prepend=-1), axis=0)).tolist()
        found: dict[int, dict[int, Tile]] = {}
        for start, stop in zip(cut, [*cut[1:], len(order)]):
            at, deep = places[:, start].tolist()
            found.setdefault(deep, {})[at] = Tile(outer[start:stop], inner[start:stop], v[start:stop])
        return rest, found

    def _by_tile(left: dict[int, Tile], right: dict[int, Tile], diagonal: bool, out: Output) -> None:
        for ti, x in left.items():
            for tj, y in right.items():
                if not (diagonal and ti > tj):
                    out.add(x, y, ti * block, tj * block, edges)

    def _cells_of(out: Output | None, at: list[int]) -> Iterator[pa.RecordBatch]:
        if out is None:
            return
        strip = max(1, (1 << 20) // cols)
        for first in range(0, rows, strip):
            i, j = np.nonzero(out.met[first:first + strip])
            if len(i):
                yield pa.RecordBatch.from_arrays([
                    pa.array(i + (at[0] * span + first)), pa.array(j + at[1] * span),
                    pa.array(out.sums[first:first + strip][i, j]),
                ], names=["i", "j", "v"])

    return run


class _Step:
    """What is known of a step of a group: pieces of both sides, the left cells put together."""

    def __init__(self, diagonal: bool) -> None:
        self.diagonal = diagonal
        self.pieces: list[list] = [[], []]
        self.left: list[np.ndarray] | None = None
        self.right = 0


def add_whole(left: np.ndarray, right: np.ndarray, out: np.ndarray) -> None:
    """Exact whole-number product: in doubles where no sum can leave their exact range, else in
    64-bit integers, or in whole numbers of any size where those could overflow on the way. A
    sum that does not fit 64 bits is an error."""
    x, y = left.astype(np.float64), right.astype(np.float64)
    bound = np.abs(x).max() * np.abs(y).max() * left.shape[1]
    if bound >= EXACT:
        bound = (np.abs(x) @ np.abs(y)).max()
    if bound < EXACT:
        product = (x @ y).astype(np.int64)
    elif bound < 2.0**62:
        product = left @ right
    else:
        product = left.astype(object) @ right.astype(object)
    if float(np.abs(out.astype(np.float64)).max()) + float(bound) >= 2.0**62:
        total = out.astype(object) + product
        out[:] = checked(total.reshape(-1)).reshape(out.shape)
    else:
        out += product
