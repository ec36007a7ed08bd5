"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

Each text gets ``BANDS * ROWS`` minima of its set of word shingles. Equal sets are one class from
then on. A band hashes a few minima; classes that share a band meet, and are candidates if the
low bits of all their minima, packed into a short signature, agree often enough: of the minima
that differ, one in four agrees in two bits by chance, and the estimate is corrected for that.
Candidates that hang together form a cluster, and inside clusters links are confirmed on the full
sets. With 32 bands of 5 rows a pair at the threshold is missed with a chance of about 1e-8 by
the bands and 1e-6 by the estimate.

Links inside a cluster are sought only as far as they can join two groups: the set of one document
is counted against an index of all others at once, and the largest group's members need not be
counted when those of all others have been. So thousands of near copies take few comparisons, and
only links that join groups leave the task.

No group is too large. Bands shared by more than ``BUCKET`` classes join them to one cluster
without estimates. Clusters beyond ``MEMBERS`` classes or ``VALUES`` shingles are cut into parts
by hash, in several ways; the groups found are joined across parts, and afterwards the classes
outside each cluster's largest group are counted against all parts.

Texts without words have an empty set and are linked with nothing. Null texts count as empty.
Repeated rows are linked like any equal texts. Rows without id take part; a component's id is its
smallest id, null if there is none, and a row is kept if its id equals that.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixq.llm.common import small, written
from matrixq.llm.components import components
from matrixq.session import tune_texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BANDS, ROWS = 32, 5
MINIMA = BANDS * ROWS
#: The estimate's standard error at the threshold is 0.033; this is five times that.
MARGIN = 0.17
BUCKET = 1024
MEMBERS, VALUES = 1024, 1 << 20
#: Candidates listed for a broadcast, 24 bytes each. With more, all texts are shuffled to them.
BROADCAST_ROWS = 1_000_000
#: Ways in which a large cluster is cut.
CUTS = 3
#: Shingles hashed at a time.
_STEP = 4096


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, width: int) -> np.ndarray:
    """The set of hashes of ``width`` successive words, sorted."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only blanks split
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    if n < width:
        whole = xxhash.xxh3_64_intdigest(b" ".join(words), seed=n)
        return np.array([whole], np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    total = np.zeros(n - width + 1, np.uint64)
    for k, factor in enumerate(_odd(5, width)):
        total += each[k : n - width + 1 + k] * factor
    return np.unique(_mix(total))


class Minima:
    """Minima of a set under ``MINIMA`` hash functions, and what is made of them."""

    def __init__(self) -> None:
        self.factor, self.shift = _odd(1, MINIMA), _odd(2, MINIMA)
        self.fold = _odd(3, ROWS)
        self.band = _odd(4, BANDS)

    def of(self, values: np.ndarray) -> np.ndarray:
        least = np.full(MINIMA, np.iinfo(np.uint64).max)
        for k in range(0, len(values), _STEP):
            some = values[k : k + _STEP, None] * self.factor + self.shift
            np.minimum(least, some.min(0), out=least)
        return least

    def bands(self, least: np.ndarray) -> np.ndarray:
        return _mix(_mix(_mix(least).reshape(BANDS, ROWS) * self.fold).sum(1) + self.band).view(np.int64)

    @staticmethod
    def packed(least: np.ndarray) -> bytes:
        low = (_mix(least) & np.uint64(3)).astype(np.uint8)
        return np.packbits(np.unpackbits(low[:, None], axis=1)[:, 6:]).tobytes()


def estimates(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Similarity of packed signatures (rows of 64-bit words), corrected for chance."""
    differ = one ^ many
    differ = (differ | (differ >> np.uint64(1))) & np.uint64(0x5555555555555555)
    same = 1 - np.bitwise_count(differ).sum(-1) / MINIMA
    return (same - 0.25) / 0.75


def _fixed(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Binary values of equal width as rows of bytes."""
    values = column.cast(pa.binary(width)).combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = values.chunk(0) if values.num_chunks else pa.array([], pa.binary(width))
    raw = np.frombuffer(values.buffers()[1] or b"", np.uint8)
    return raw[values.offset * width : (values.offset + len(values)) * width].reshape(-1, width)


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold whole runs of rows with equal keys, from rows in the order of keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch[key].to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1]))  # the last run may go on in the next batch
        if held and keys[0] != held[0][key][-1].as_py():
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _bounds(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return first, np.append(first[1:], len(keys))


def _links(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Links ``(a, b)`` of 16-byte nodes."""
    def column(k: int) -> pa.Array:
        rows = np.concatenate([p[k] for p in pairs]) if pairs else np.empty((0, 16), np.uint8)
        flat = np.ascontiguousarray(rows).tobytes()
        return pa.Array.from_buffers(
            pa.binary(16), len(rows), [None, pa.py_buffer(flat)]
        ).cast(pa.binary())

    return pa.RecordBatch.from_arrays([column(0), column(1)], ["a", "b"])


def bucket_links(nodes: np.ndarray, signatures: np.ndarray, least: float) -> list:
    """Links that span each group of classes whose signatures are alike."""
    left, out = np.arange(len(nodes)), []
    while len(left) > 1:
        group, left = [left[0]], left[1:]
        while group and len(left):
            one = group.pop()
            alike = estimates(signatures[one], signatures[left]) >= least
            if alike.any():
                near = left[alike]
                out.append((nodes[near], np.repeat(nodes[one : one + 1], len(near), 0)))
                group.extend(near.tolist())
                left = left[~alike]
    return out


class Groups:
    """Disjoint sets that know their sizes."""

    def __init__(self, n: int) -> None:
        self.up, self.size = list(range(n)), [1] * n

    def top(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.top(x), self.top(y)
        if x == y:
            return False
        if self.size[x] < self.size[y]:
            x, y = y, x
        self.up[y] = x
        self.size[x] += self.size[y]
        return True


class Overlaps:
    """Which sets share enough with a given one, counted over an index of all their members."""

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.percent = percent
        self.sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        values = np.concatenate(sets)
        order = np.argsort(values, kind="stable")
        self.owner = owner[order]
        _, place = np.unique(values, return_inverse=True)
        self.starts = np.append(0, np.cumsum(np.bincount(place)))
        self.places = np.split(place, np.cumsum(self.sizes)[:-1])

    def linked(self, k: int) -> np.ndarray:
        first, last = self.starts[self.places[k]], self.starts[self.places[k] + 1]
        many = last - first
        ends = np.cumsum(many)
        index = np.repeat(first - ends + many, many) + np.arange(ends[-1])
        both = np.bincount(self.owner[index], minlength=len(self.sizes))
        either = self.sizes + self.sizes[k] - both
        return np.flatnonzero(100 * both >= self.percent * either)


def set_links(nodes: np.ndarray, sets: list[np.ndarray], percent: int,
              known: np.ndarray | None = None) -> list:
    """Links that span the groups of sets at least ``percent`` alike.

    ``known`` has numbers of groups that are joined already. All members of all groups but the
    largest are counted against everything, so no link between two groups is lost.
    """
    n = len(sets)
    groups, found = Groups(n), []
    if known is not None:
        first: dict[int, int] = {}
        for k, g in enumerate(known.tolist()):
            groups.join(first.setdefault(g, k), k)
    parts = len({groups.top(k) for k in range(n)})
    if parts == 1:
        return []
    overlaps = Overlaps(sets, percent)
    largest = max(range(n), key=lambda k: groups.size[groups.top(k)])
    waiting, passed = list(range(n)), []
    while parts > 1 and waiting:
        k = waiting.pop()
        if groups.top(k) == groups.top(largest):
            passed.append(k)
            continue
        for j in overlaps.linked(k).tolist():
            if groups.join(j, k):
                parts -= 1
                found.append((k, j))
        if groups.size[groups.top(k)] > groups.size[groups.top(largest)]:
            largest = k
            waiting, passed = waiting + passed, []
    if not found:
        return []
    at = np.array(found)
    return [(nodes[at[:, 0]], nodes[at[:, 1]])]


def _sketches(width: int):
    @F.pandas_udf("n long, node binary, signature binary, bands array<long>")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        minima = Minima()
        for texts in batches:
            out = []
            for text in texts:
                values = shingles(text, width)
                if len(values):
                    least = minima.of(values)
                    node = xxhash.xxh3_128_digest(values.tobytes())
                    out.append((len(values), node, minima.packed(least), minima.bands(least)))
                else:
                    out.append((0, None, None, None))
            yield pd.DataFrame(out, columns=["n", "node", "signature", "bands"])

    return sketch


def _candidates(classes: DataFrame, least: float) -> DataFrame:
    """Links ``(a, b)`` that span all groups of classes which may be linked."""
    keys = classes.select("node", F.explode("bands").alias("band"))
    counts = keys.groupBy("band").agg(F.count("*").alias("many"), F.min("node").alias("first"))
    shared = written(keys.join(counts.where("many > 1"), "band"), "bands")
    large = shared.where(F.col("many") > BUCKET).select(
        F.col("node").alias("a"), F.col("first").alias("b")
    )
    usual = shared.where(F.col("many") <= BUCKET).select("node", "band")
    met = usual.join(classes.select("node", "signature"), "node")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "band"):
            nodes = _fixed(table["node"], 16)
            signatures = _fixed(table["signature"], MINIMA // 4).view(np.uint64)
            first, last = _bounds(table["band"].to_numpy())
            two = first[last - first == 2]
            alike = two[estimates(signatures[two], signatures[two + 1]) >= least]
            pairs = [(nodes[alike], nodes[alike + 1])]
            for f, t in zip(first, last):
                if t - f > 2:
                    pairs += bucket_links(nodes[f:t], signatures[f:t], least)
            yield _links(pairs)

    sorted_ = met.repartition("band").sortWithinPartitions("band")
    return large.unionByName(sorted_.mapInArrow(link, "a binary, b binary"))


def _confirm(members: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` inside runs of rows ``(part, node, known, items)`` with equal ``part``."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "part"):
            nodes = _fixed(table["node"], 16)
            known = table["known"].to_numpy()
            first, last = _bounds(table["part"].to_numpy())
            pairs = []
            for f, t in zip(first.tolist(), last.tolist()):
                if t - f > 1:
                    sets = [np.frombuffer(x, np.uint64) for x in table["items"][f:t].to_pylist()]
                    # Groups that are known already; -1 stands for none.
                    own = np.where(known[f:t] == -1, -2 - np.arange(t - f), known[f:t])
                    pairs += set_links(nodes[f:t], sets, percent, own)
            yield _links(pairs)

    sorted_ = members.select("part", "node", "known", "items")
    return sorted_.repartition("part").sortWithinPartitions("part").mapInArrow(
        link, "a binary, b binary"
    )


def _link_large(large: DataFrame, percent: int) -> DataFrame:
    """Links inside clusters too large for one task; rows ``(cluster, parts, node, items)``.

    Each cluster is cut by hash in several ways and the groups found are joined. What is then
    outside of a cluster's largest group is counted against every part once more.
    """
    cuts = F.explode(F.sequence(F.lit(1), F.lit(CUTS))).alias("cut")
    cut = large.select("*", cuts).withColumn(
        "part", F.xxhash64("cluster", "cut", F.pmod(F.xxhash64("node", "cut"), F.col("parts")))
    )
    links = written(
        _confirm(cut.withColumn("known", F.lit(-1).cast("long")), percent), "set-links"
    )
    groups = components(links)
    joined = written(
        large.join(groups, "node", "left")
        .withColumn("group", F.coalesce("component", "node")), "groups",
    )
    sizes = joined.groupBy("cluster", "group").agg(F.count("*").alias("size"))
    top = sizes.groupBy("cluster").agg(F.max(F.struct("size", "group")).alias("top"))
    known = joined.join(top, "cluster").select(
        "cluster", "parts", "node", "items", F.xxhash64("group").alias("known"),
        (F.col("group") != F.col("top.group")).alias("other"),
    )
    places = F.when(F.col("other"), F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("node"), F.col("parts")))
    )
    meeting = known.withColumn("place", F.explode(places))
    again = _confirm(
        meeting.withColumn("part", F.xxhash64("cluster", "place")), percent
    )
    return links.unionByName(again)


def near_duplicates(df: DataFrame, percent: int, key: str = "doc_id", text: str = "text",
                    width: int = 5) -> DataFrame:
    """Adds ``n_shingles``, ``component_id``, ``kept`` and ``first``; two texts are linked if their
    sets of ``width``-word shingles have at least ``percent`` hundredths of their union in common.
    Exactly one row of a component is ``first``, also where rows repeat their id.

    The added columns replace any of the same name. ``text`` is not returned.
    """
    tune_texts(df.sparkSession)
    names = ("n_shingles", "component_id", "kept", "first")
    kept = [c for c in df.columns if c not in (*names, text)]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = written(
        df.select(*[F.col(f"`{c}`") for c in kept], F.xxhash64(body).alias("__hash"),
                  _sketches(width)(body).alias("__s"))
        .select("*", *[F.col(f"__s.{x}").alias(f"__{x}") for x in ("n", "node", "signature", "bands")],
                F.monotonically_increasing_id().alias("__place")).drop("__s"), "sketches",
    )
    order = F.struct(  # rows without id come last
        F.col(f"`{key}`").isNull().alias("no_id"), F.col(f"`{key}`").alias("id"),
        F.col("__place").alias("place"),
    )
    # One class per set: copies are counted together before anything is joined.
    classes = written(
        rows.where("__n > 0").groupBy(F.col("__node").alias("node")).agg(
            F.min(order).alias("least"), F.min("__hash").alias("hash"), F.min("__n").alias("n"),
            F.min("__signature").alias("signature"), F.min("__bands").alias("bands"),
        ), "classes",
    )
    clusters = written(
        components(_candidates(classes, percent / 100 - MARGIN)).select(
            "node", F.col("component").alias("cluster")
        ).join(classes.select("node", "hash", "n"), "node"), "clusters",
    )
    @F.pandas_udf("binary")
    def items(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shingles(t, width).tobytes() for t in texts])

    # The texts of candidates alone, one for each class, are turned into sets again.
    wanted = small(clusters.select("hash", "node"), BROADCAST_ROWS)
    texts = df.select(F.xxhash64(body).alias("hash"), body.alias("text")).join(wanted, "hash")
    sets = texts.groupBy("node").agg(F.min("text").alias("text")).select(
        "node", items("text").alias("items")
    )
    sizes = clusters.groupBy("cluster").agg(
        F.count("*").alias("classes"), F.sum("n").alias("values")
    )
    parts = F.ceil(F.greatest(F.col("classes") / MEMBERS, F.col("values") / VALUES))
    ready = written(
        sets.join(clusters.select("node", "cluster"), "node")
        .join(sizes.select("cluster", parts.alias("parts")), "cluster"), "sets",
    )
    whole = ready.where("parts = 1").withColumn("part", F.xxhash64("cluster"))
    links = _confirm(whole.withColumn("known", F.lit(-1).cast("long")), percent)
    large = ready.where("parts > 1")
    if large.limit(1).count():
        links = links.unionByName(_link_large(large, percent))
    groups = components(links)
    named = classes.select("node", "least").join(groups, "node", "left").select(
        "node", "least", F.coalesce("component", "node").alias("component")
    )
    tops = named.groupBy("component").agg(F.min("least").alias("top"))
    found = named.join(tops, "component").select(
        F.col("node").alias("__node"), F.col("top").alias("__top")
    )
    own = F.when(F.col("__n") > 0, F.col("__top.id")).otherwise(F.col(f"`{key}`"))
    first = (F.col("__n") == 0) | (F.col("__top.place") == F.col("__place"))
    return (
        rows.join(found, "__node", "left")
        .withColumn("component_id", own)
        .select(*[F.col(f"`{c}`") for c in kept], F.col("__n").alias("n_shingles"), "component_id",
                F.col(f"`{key}`").eqNullSafe(F.col("component_id")).alias("kept"), first.alias("first"))
    )
