"""Spelling variants: words one edit apart, by Bloom-guided neighbourhoods.

Words are maximal runs of Latin letters, A-Z in lower case. A known few occurrences lose a letter
(see ``spoiled``), as a contract of the query asks. Words that are long and frequent enough form
the vocabulary.

All deletions and replacements of each vocabulary word are generated as hashes and looked up in
blocked Bloom filters of the vocabulary, one shard for each length. Only what a filter lets pass
becomes a string and is shuffled to an exact join with the vocabulary, which removes the false
positives. Insertions need no probes of their own: they are the deletions seen from the other word.

Hashes are polynomials in the letters modulo 2**64. The hash of a word with one letter replaced or
left out follows from sums over the word's beginning and end, so a word of ``n`` letters costs
one addition for each variant and no string at all. The filters together hold no more than
``FILTER_WORDS`` words of 64 bits, whatever the vocabulary, so they may be sent to every task; a
larger vocabulary gives more false positives for the join and the same result.

A word's form is its most frequent near word, if that is ``ratio`` times as frequent; forms are
followed to their roots by doubling, as frequencies rise with each step. Null texts have no words,
a null id counts as empty text in the hash of an occurrence, and repeated rows each count. Empty
tables give no rows.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixq.llm.common import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Letters of words, as bytes of Latin-1, in which each letter is one byte.
RUNS = re.compile(rb"[A-Za-z\xC0-\xFF]+")
LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint64)
#: Occurrences whose hash this divides lose a letter.
SPOILED = 199
#: Distinct words a task counts before it hands them on.
COUNTED = 300_000
#: 64-bit words of all filters together (128 MB), for each word of the vocabulary, and shards.
FILTER_WORDS, SHARE, SHARDS = 1 << 24, 0.25, 64
#: Variants a task has at hand at a time.
AT_HAND = 1 << 20

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
INVERSE = pow(BASE, -1, 1 << 64)


def spoiled(doc_id: bytes, run: bytes) -> bytes:
    """The lower-case run as this document has it: with one letter less if the hash of both says
    so. ``run`` is in Latin-1."""
    coded = run if run.isascii() else run.decode("latin-1").encode()
    h = zlib.crc32(doc_id + b":" + coded)
    if h % SPOILED:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def count_words(df: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """Rows ``(word, n)``: words of at least ``least`` letters and how often they occur."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in seen]
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(list(seen.values()), pa.int64())],
                names=["word", "n"],
            )

        for batch in batches:
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                # Letters beyond Latin-1 become question marks, which end a run as they do.
                plain = body.as_py().encode("latin-1", "replace").lower()
                start = doc_id.encode()
                for run, n in Counter(RUNS.findall(plain)).items():
                    if len(run) < least:
                        continue
                    word = spoiled(start, run)
                    if len(word) >= least:
                        seen[word] += n
                if len(seen) >= COUNTED:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    known = df.where(F.col(f"`{text}`").isNotNull()).select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"),
        F.col(f"`{text}`").alias("body"),
    )
    return known.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def powers(size: int) -> np.ndarray:
    factors = np.full(size + 1, BASE, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads all bits of a hash over all bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def shard_of(length: int) -> int:
    return min(length, SHARDS) - 1


def letters_of(words: list[bytes]) -> np.ndarray:
    """Words of one length as rows of letters."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1).astype(np.uint64)


def hashes(letters: np.ndarray) -> np.ndarray:
    return (letters * powers(letters.shape[1])[:-1]).sum(1, dtype=np.uint64)


def marks(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each hash and the bits it sets there, four at the most."""
    h = mixed(h)
    block = (h >> np.uint64(32)) & np.uint64(blocks - 1)
    bits = np.zeros(len(h), np.uint64)
    for shift in (0, 6, 12, 18):
        bits |= np.uint64(1) << ((h >> np.uint64(shift)) & np.uint64(63))
    return block.astype(np.int64), bits


class Filters:
    """Blocked Bloom filters, one for each shard of lengths."""

    def __init__(self, shards: dict[int, np.ndarray], lengths: set[int]) -> None:
        self.shards, self.lengths = shards, lengths

    def passes(self, length: int, h: np.ndarray) -> np.ndarray:
        """Places of the hashes of words of one length that may be in the vocabulary."""
        words = self.shards[shard_of(length)]
        block, bits = marks(h, len(words))
        return np.flatnonzero((words[block] & bits) == bits)


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, list[bytes]]]:
    """Words of a batch by length: the length, their rows and the words in Latin-1."""
    words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield size, rows, [words[r] for r in rows]


def filters_of(vocabulary: DataFrame) -> Filters:
    """Runs a job for the number of words of each shard and one that fills the filters."""
    shard = F.least(F.length("word"), F.lit(SHARDS))
    sizes = {r["s"] - 1: r["n"] for r in vocabulary.groupBy(shard.alias("s")).agg(
        F.count("*").alias("n")).collect()}
    total = max(1, sum(sizes.values()))
    blocks = {}
    for s, n in sizes.items():
        wanted = max(1, min(int(n * SHARE), FILTER_WORDS * n // total))
        blocks[s] = 1 << (wanted.bit_length() - 1)  # rounded down, so the sum keeps the bound
    # Beyond the shards lengths may be of any number; a flag for each of the first ones is enough.
    lengths = {r["n"] for r in vocabulary.select(
        F.least(F.length("word"), F.lit(SHARDS)).alias("n")).distinct().collect()}

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, _, words in by_length(batch):
                s = shard_of(size)
                block, bits = marks(hashes(letters_of(words)), blocks[s])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(block), s, np.int32)), pa.array(block),
                     pa.array(bits.view(np.int64))], names=["shard", "block", "bits"],
                )

    filled = vocabulary.select("word").mapInArrow(fill, "shard int, block long, bits long")
    found = filled.groupBy("shard", "block").agg(F.bit_or("bits").alias("bits")).toArrow()
    shards = {s: np.zeros(n, np.uint64) for s, n in blocks.items()}
    at, block = found["shard"].to_numpy(), found["block"].to_numpy()
    bits = found["bits"].to_numpy().view(np.uint64)
    for s, words in shards.items():
        words[block[at == s]] = bits[at == s]
    return Filters(shards, lengths)


def deletions(letters: np.ndarray) -> np.ndarray:
    """Hashes of the words without their k-th letter, for each k."""
    terms = letters * powers(letters.shape[1])[:-1]
    ends = np.cumsum(terms, 1, dtype=np.uint64)
    behind = (ends[:, -1:] - ends) * np.uint64(INVERSE)
    return ends - terms + behind


def replacements(letters: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Hashes of the words with the letters at some places replaced by each letter."""
    weight = powers(letters.shape[1])[places]
    whole = hashes(letters)[:, None, None]
    apart = LETTERS[None, None, :] - letters[:, places, None]
    return whole + apart * weight[None, :, None]


def variants(batch: pa.RecordBatch, filters: Filters) -> Iterator[pa.RecordBatch]:
    """Rows ``(word, n, near, deleted)``: variants that may be words."""
    counts = batch.column("n").to_numpy()
    for size, rows, words in by_length(batch):
        shorter = min(size - 1, SHARDS) in filters.lengths
        step = max(1, AT_HAND // (size * len(LETTERS)))
        for start in range(0, len(words), step):
            some = words[start:start + step]
            letters = letters_of(some)
            of, near, deleted = [], [], []
            if shorter and size > 1:
                for hit in filters.passes(size - 1, deletions(letters).ravel()).tolist():
                    w, k = divmod(hit, size)
                    # Of a run of equal letters it does not matter which one goes.
                    if k == 0 or some[w][k] != some[w][k - 1]:
                        of.append(w)
                        near.append(some[w][:k] + some[w][k + 1:])
                        deleted.append(True)
            width = max(1, AT_HAND // (len(some) * len(LETTERS)))
            for first in range(0, size, width):
                places = np.arange(first, min(size, first + width))
                h = replacements(letters, places).ravel()
                for hit in filters.passes(size, h).tolist():
                    rest, c = divmod(hit, len(LETTERS))
                    w, k = divmod(rest, len(places))
                    k += first
                    letter = int(LETTERS[c])
                    if some[w][k] != letter:
                        of.append(w)
                        near.append(some[w][:k] + bytes([letter]) + some[w][k + 1:])
                        deleted.append(False)
            if of:
                yield pa.RecordBatch.from_arrays([
                    pa.array([some[w].decode("latin-1") for w in of]),
                    pa.array(counts[rows[start:start + step]][of]),
                    pa.array([x.decode("latin-1") for x in near]), pa.array(deleted),
                ], names=["word", "n", "near", "deleted"])


def near_words(vocabulary: DataFrame) -> DataFrame:
    """Rows ``(word, near, near_n)`` for each ordered pair of words one edit apart, from distinct
    rows ``(word, n)``."""
    filters = filters_of(vocabulary)
    if not filters.shards:
        return vocabulary.select("word", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    sent = vocabulary.sparkSession.sparkContext.broadcast((filters.shards, filters.lengths))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Filters(*sent.value)
        for batch in batches:
            yield from variants(batch, held)

    possible = vocabulary.mapInArrow(probe, "word string, n long, near string, deleted boolean")
    exact = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = possible.join(exact, "near")
    there = F.struct("word", "near", "near_n")
    back = F.struct(
        F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")
    )
    both = F.when(F.col("deleted"), F.array(there, back)).otherwise(F.array(there))
    return pairs.select(F.explode(both).alias("p")).select("p.*")


def follow(forms: DataFrame) -> DataFrame:
    """Rows ``(word, root)`` from rows ``(word, form)``, by following each form to the last.

    Each round doubles the steps that a word has gone, so the rounds grow with the logarithm of
    the longest chain, and a chain with that of the greatest frequency.
    """
    steps = forms.select("word", F.col("form").alias("root"))
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        steps = written(
            steps.join(on, "root", "left").select(
                "word", F.coalesce("__next", "root").alias("root"),
                F.col("__next").isNotNull().alias("moved"),
            ), "roots",
        )
        if not steps.where("moved").limit(1).count():
            return steps.drop("moved")
        steps = steps.drop("moved")


def group(df: DataFrame, key: str = "doc_id", text: str = "text", least_letters: int = 6,
          least_rows: int = 5, ratio: int = 5) -> DataFrame:
    """Rows ``(word, form, root, n, n_near, form_n)`` for each word of the vocabulary."""
    counted = count_words(df, key, text, least_letters)
    vocabulary = written(counted.where(F.col("n") >= least_rows), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_words(vocabulary).groupBy("word").agg(
        F.count("*").alias("n_near"), best.alias("best")
    )
    strong = -F.col("best.less") >= ratio * F.col("n")
    words = written(
        vocabulary.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, F.col("best.near")).alias("form"),
            F.when(strong, -F.col("best.less")).alias("form_n"),
        ), "words",
    )
    roots = follow(words.where("form is not null").select("word", "form"))
    return words.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
