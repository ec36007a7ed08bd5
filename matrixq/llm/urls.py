"""URL filters: a blocked Bloom filter in front of an exact hash join.

An entry ``(host, path, verdict)`` fits a URL whose host is the entry's or a subdomain of it and
whose path starts with the entry's. Every URL has a few expansions: each ending of its host at a
dot, with no more labels than some entry has, with each beginning of its path of a length that some
entry has. An expansion is a possible
hit if all bits of its mask are set in one 256-bit block of the filter; possible hits are joined
to the entries by hash and full strings, which removes false positives. Of the entries that fit,
the longest decides, then the one with the longer host, then the blocking one.

Expansions are made once for each pair of host and path beginning, not for each URL, so a host
with a third of all pages is looked up once. The filter and the entries are broadcast up to a
counted number of entries and joined by shuffles beyond.

Null URLs and URLs without ``://`` have an empty host and path and fit no entry. Repeated rows are
judged alike and all kept. An empty list lets every URL through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matrixq.llm.common import lower_ascii, written

#: Filter bits per entry; a block has 256 bits in four words, two bits of each are set.
BITS_PER_ENTRY = 16
#: Entries up to which the filter and the list are broadcast: some 20 MB of short URLs.
BROADCAST_ENTRIES = 200_000

_AFTER_SCHEME = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    text = F.coalesce(url, F.lit(""))
    return (
        lower_ascii(F.regexp_extract(text, _AFTER_SCHEME, 1)),
        F.regexp_extract(text, _AFTER_SCHEME, 2),
    )


def _hash(host: Column, path: Column) -> Column:
    return F.xxhash64(host, path)


def _masks(h: Column) -> list[Column]:
    """One mask per word of a block, two bits each, from a second hash of the key."""
    bits = F.xxhash64(h, F.lit("bits"))

    def bit(place: int) -> Column:
        return F.call_function(
            "shiftleft", F.lit(1).cast("long"),
            F.shiftrightunsigned(bits, place).bitwiseAND(F.lit(63)).cast("int"),
        )

    return [bit(12 * w).bitwiseOR(bit(12 * w + 6)) for w in range(4)]


def bloom_filter(entries: DataFrame, blocks: int) -> DataFrame:
    """Rows ``(block, w0, w1, w2, w3)`` for entries with a column ``h``."""
    masked = entries.select(
        F.pmod("h", F.lit(blocks)).alias("block"),
        *[m.alias(f"m{w}") for w, m in enumerate(_masks(F.col("h")))],
    )
    return masked.groupBy("block").agg(*[F.bit_or(f"m{w}").alias(f"w{w}") for w in range(4)])


def judge(df: DataFrame, entries: DataFrame, url: str = "url", otherwise: str = "allow",
          broadcast_entries: int = BROADCAST_ENTRIES) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict``; columns of these names are replaced.

    ``entries`` has strings ``host``, ``path`` and ``verdict`` and a boolean ``listed``. An entry
    that is merely listed gives way to any other, and names no rule.
    """
    names = ("host", "path", "rule", "verdict")
    kept = [c for c in df.columns if c not in names]
    listed = written(
        entries.select("host", "path", "verdict", "listed").distinct()
        .withColumn("h", _hash(F.col("host"), F.col("path"))), "entries",
    )
    labels = F.split("host", r"\.")
    seen = listed.groupBy(F.length("path").alias("n")).agg(
        F.count("*").alias("rows"), F.max(F.size(labels)).alias("labels")
    ).collect()
    lengths = sorted(r["n"] for r in seen)  # no more than the longest path has characters
    most = max((r["labels"] for r in seen), default=0)
    count = sum(r["rows"] for r in seen)
    host, path = host_and_path(F.col(f"`{url}`"))
    pages = df.select(*[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"))
    if not count:
        return pages.select(
            "*", F.lit(None).cast("string").alias("rule"), F.lit(otherwise).alias("verdict")
        )
    small = F.broadcast if count <= broadcast_entries else (lambda x: x)
    pages = pages.withColumn("__cut", F.substring("path", 1, max(lengths)))

    pairs = pages.select("host", "__cut").where("host <> ''").distinct()
    # Endings with more labels than any entry has cannot be one.
    endings = F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(labels) - most + 1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
    )
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("__cut"))
    expanded = (
        pairs.withColumn("ending", F.explode(endings))
        .withColumn("n", F.explode(fitting))
        .withColumn("begin", F.substring(F.col("__cut"), F.lit(1), F.col("n")))
        .withColumn("h", _hash(F.col("ending"), F.col("begin")))
    )
    blocks = max(1, -(-count * BITS_PER_ENTRY // 256))
    masked = expanded.select(
        "*", F.pmod("h", F.lit(blocks)).alias("block"),
        *[m.alias(f"m{w}") for w, m in enumerate(_masks(F.col("h")))],
    )
    in_filter = reduce(
        Column.__and__,
        [F.col(f"w{w}").bitwiseAND(F.col(f"m{w}")) == F.col(f"m{w}") for w in range(4)],
    )
    possible = masked.join(small(bloom_filter(listed, blocks)), "block").where(in_filter)
    exact = possible.select("host", "__cut", "h", "ending", "begin").join(
        small(listed.select("h", F.col("host").alias("ending"), F.col("path").alias("begin"),
                            F.col("verdict").alias("__verdict"), "listed")),
        ["h", "ending", "begin"],
    )
    rank = F.struct(
        ~F.col("listed"), F.length("ending") + F.length("begin"), F.length("ending"),
        F.col("__verdict") == "block",
    )
    named = F.when(~F.col("listed"), F.concat("ending", "begin"))
    best = exact.groupBy("host", "__cut").agg(
        F.max_by(F.struct(named.alias("rule"), F.col("__verdict").alias("verdict")), rank)
        .alias("__best")
    )
    return pages.join(best, ["host", "__cut"], "left").select(
        *[F.col(f"`{c}`") for c in kept], "host", "path", F.col("__best.rule").alias("rule"),
        F.coalesce("__best.verdict", F.lit(otherwise)).alias("verdict"),
    )
