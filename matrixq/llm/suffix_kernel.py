"""Arrays of bytes: anchors of repeats, suffix order, and common prefixes by backward extension."""

from __future__ import annotations

import numpy as np

#: Windows looked at together; places fit into the low bits of a packed hash.
CHUNK, PLACE_BITS = 1 << 20, 22


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


class Roller:
    """Hashes of any substrings of a text from prefix sums of a polynomial modulo 2**64."""

    def __init__(self) -> None:
        self.code = _odd(11, 256)
        base = 0x9E3779B97F4A7C15
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < n:  # doubling: the second half is the first times a power
            factor = np.uint64(pow(base, len(out), 1 << 64))
            out = np.concatenate([out, out * factor])
        return out

    def prefixes(self, text: np.ndarray) -> np.ndarray:
        n = len(text) + 1
        if len(self.powers) < n:
            self.powers = self._powers(self.base, n)
            self.inverses = self._powers(self.inverse, n)
        sums = np.zeros(n, np.uint64)
        np.cumsum(self.code[text] * self.powers[: n - 1], out=sums[1:])
        return sums

    def hashes(self, sums: np.ndarray, first: np.ndarray | slice, last: np.ndarray | slice) -> np.ndarray:
        return _mix((sums[last] - sums[first]) * self.inverses[first])


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` successive values."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(text: np.ndarray, length: int, gram: int, roller: Roller) -> tuple:
    """Runs of windows of ``length`` bytes that choose the same gram, that with the least hash.

    Equal windows choose equal grams at equal places inside them, so windows can only be equal if
    their anchors' hashes are. Returns arrays: the anchor's hash, the hash of all text under the
    run's windows, the first window and the number of windows.
    """
    out = []
    for start in range(0, len(text) - length + 1, CHUNK):
        part = text[start : start + CHUNK + length - 1]
        sums = roller.prefixes(part)
        n = len(part)
        grams = roller.hashes(sums, slice(0, n - gram + 1), slice(gram, n + 1))
        packed = grams >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)
        packed |= np.arange(len(grams), dtype=np.uint64)
        chosen = window_minima(packed, length - gram + 1)
        at = (chosen & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        many = np.diff(first, append=len(at))
        whole = roller.hashes(sums, first, first + many - 1 + length)
        out.append((grams[at[first]], whole, first + start, many))
    return tuple(np.concatenate(x) for x in zip(*out))


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes in the order of at least their first ``depth`` symbols."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | padded[k : k + n]
    size = 8
    while True:
        order = np.argsort(key)
        steps = np.concatenate([[False], key[order][1:] != key[order][:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(steps) + 1
        if size >= depth or rank[order[-1]] == n:
            return order
        next_ = np.zeros(n, np.int64)
        next_[: n - size] = rank[size:]
        key = (rank << 32 | next_).view(np.uint64)
        size *= 2


class Backward:
    """Backward extension of intervals of suffixes on the Burrows-Wheeler transform."""

    #: Intervals of so many suffixes are extended one suffix at a time, larger ones by ranks.
    SMALL = 16

    def __init__(self, text: np.ndarray, order: np.ndarray, symbols: int) -> None:
        self.n, self.symbols = len(text), symbols
        self.bwt = text[order - 1]
        counts = np.bincount(text, minlength=symbols)
        self.starts = np.cumsum(counts) - counts
        by_symbol = np.argsort(self.bwt, kind="stable")
        self.step = np.empty(self.n, np.int64)  # where a suffix goes with the symbol before it
        self.step[by_symbol] = np.arange(self.n)
        self.places = [by_symbol[s : s + c] for s, c in zip(self.starts, counts)]

    def extend(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All intervals of one symbol more in front of the given ones."""
        size = high - low
        small = size <= self.SMALL
        lows, highs = [], []
        if small.any():
            first, many = low[small], size[small]
            ends = np.cumsum(many)
            rows = np.repeat(first - ends + many, many) + np.arange(ends[-1])
            owner = np.repeat(np.arange(len(first)), many)
            key = owner * self.symbols + self.bwt[rows]
            order = np.argsort(key, kind="stable")
            key, to = key[order], self.step[rows[order]]
            begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            lows.append(to[begins])
            highs.append(to[begins] + np.diff(begins, append=len(key)))
        if not small.all():
            a, b = low[~small], high[~small]
            for c in range(self.symbols):
                if len(self.places[c]):
                    x = self.starts[c] + np.searchsorted(self.places[c], a)
                    y = self.starts[c] + np.searchsorted(self.places[c], b)
                    some = x < y
                    lows.append(x[some])
                    highs.append(y[some])
        return np.concatenate(lows), np.concatenate(highs)


def repeat_groups(text: np.ndarray, order: np.ndarray, symbols: int, length: int) -> np.ndarray:
    """Numbers the suffixes, in their order: equal numbers for equal first ``length`` symbols.

    Intervals of suffixes with a common prefix are extended breadth first. An interval of strings
    one longer ends where common prefixes are exactly as long as the strings it came from, unless
    a shorter value was found there before; such a place is settled, and only intervals that settle
    a place are extended again. After ``length`` rounds the places that are not settled lie between
    suffixes with at least that much in common.
    """
    n = len(text)
    back = Backward(text, order, symbols)
    settled = np.zeros(n + 1, bool)
    settled[0] = True
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for _ in range(length):
        low, high = back.extend(low, high)
        # The end of all suffixes has no common prefix; what ends there is always extended.
        new = ~settled[high]
        settled[high[new & (high < n)]] = True
        low, high = low[new], high[new]
        if not len(low):
            break
    return np.cumsum(settled[:n])


def repeats(segments: list[np.ndarray], many: np.ndarray, docs: np.ndarray, first: np.ndarray,
            length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which windows also start earlier: numbers of segments and of windows in them.

    Segment ``k`` has the bytes under ``many[k]`` windows, the first of which is window
    ``first[k]`` of document ``docs[k]``.
    """
    lengths = np.array([len(s) for s in segments])
    begin = np.cumsum(lengths + 1) - lengths - 1
    raw = np.full(begin[-1] + lengths[-1] + 1, -1, np.int16)
    inside = np.ones(len(raw), bool)
    inside[begin + lengths] = False  # one separator behind each
    raw[inside] = np.concatenate(segments)
    used = np.unique(raw)  # separators come first
    text = np.searchsorted(used, raw).astype(np.uint8) if len(used) < 256 else None
    if text is None:  # all 255 or 256 byte values: symbols of two parts would not pay, keep wide
        text = np.searchsorted(used, raw)
        order = _wide_order(text, length)
    else:
        order = suffix_order(text, length)
    groups = repeat_groups(text, order, len(used), length)
    ends = np.cumsum(many)
    window = np.arange(ends[-1]) - np.repeat(ends - many, many)
    segment = np.repeat(np.arange(len(many)), many)
    of_place = np.empty(len(text), np.int64)
    of_place[order] = groups
    group = of_place[begin[segment] + window]
    doc, start = docs[segment], first[segment] + window
    by = np.lexsort((start, doc, group))
    heads = np.concatenate([[True], group[by][1:] != group[by][:-1]])
    head = by[np.maximum.accumulate(np.where(heads, np.arange(len(by)), 0))]
    later = (doc[by] != doc[head]) | (start[by] != start[head])
    found = np.sort(by[later])
    return segment[found], window[found]


def _wide_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Like ``suffix_order`` for symbols of more than eight bits."""
    n, rank, size = len(text), text.astype(np.int64) + 1, 1
    while True:
        next_ = np.zeros(n, np.int64)
        next_[: n - size] = rank[size:]
        key = rank << 32 | next_
        order = np.argsort(key)
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[False], key[order][1:] != key[order][:-1]])) + 1
        size *= 2
        if size >= depth:
            return order
