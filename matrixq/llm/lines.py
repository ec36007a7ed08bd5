"""Line dedup: exact copies and lines within a few edits of an earlier line, in native functions.

Lines are in the order of their document's id, then of their place. A line is removed if it
occurs earlier, or if an earlier different line is within its edits: ``EDITS`` at most, and no
more than one for each ``CHARS_PER_EDIT`` characters of the shorter line. Shorter lines are
removed as exact copies only. Empty lines stay where they are.

Near lines are found by a segment-partition join. A line of length ``n`` is cut into one segment
more than the edits; of two lines within the edits, the longer one holds one of the other's
segments unchanged, near the same place. Each line is entered under its segments and looked up
under those of its own substrings that could be a segment of a line of its own length or of a
little less; substrings are told by length, number and place, so few are needed.

A segment that very many lines share makes a crowd, as lines of one mould do. There, all lines of
crowds together, another test comes first: pairs of neighbouring characters are dealt into classes by
a hash, one class more than two edits can change. So of two lines within the edits some class
holds the same pairs, each as often, in both, wherever they stand. Lines of one mould that
differ in a word or more have few classes in common. Up to ``ALIKE`` lines that agree in a class are
compared by a word of parities each. More are told apart by classes of single characters as
well, and by both once more with another hash.

A line needs one earlier partner, not all. So in all of this each line is compared with the earliest
one of its group first, and only where some are not near it does the group go on, without that
line. What the classes leave is cut into segments once more, the shared segment is cut out, and so
forth. A pair that shares several segments is looked for under the first of them only: a group whose
lines all agree in an earlier segment as well has nothing to add. What is left gets shorter each
round, until its at most ``TINY`` characters are told by patterns: two texts are within ``e`` edits
if and only if replacing characters by a joker, or putting jokers in, ``e`` times in all, can make
them equal. So of all lines of one pattern only the earliest can have no earlier partner there, and
no pairs are formed. A middle segment leaves a row of marks, one more than the edits, which keeps
both sides apart.

Pairs of lines that meet and whose parities of character pairs allow it are checked by a banded
bit-parallel automaton: one word of bits for each number of edits, one bit for each diagonal of the
band, all moved together by each character.

Marks and the joker are code points that Unicode keeps free of characters or for private use; lines
that hold one nevertheless are not compared within crowds.

Exact copies are told by two 64-bit hashes; they are counted together before they are joined, and
only the first occurrence of a line is entered. Texts that are null count as empty: one empty line,
nothing to remove. Rows with equal id and text are one document, all treated alike. Rows without
id come last.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matrixq.llm.common import small, written

EDITS, CHARS_PER_EDIT = 2, 20
#: Copies listed for a broadcast: 40 bytes each. More are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Lines under one segment that are compared one by one; more are a crowd. Lines of a crowd that
#: agree in a class and are compared by parities, one by one.
CROWD, ALIKE = 8, 512
#: Characters left of a line, from which on it is told by patterns.
TINY = 12
#: Code points that no text should hold, those that are no characters and some of private use: the
#: joker, then a mark for each round; a round cuts off a quarter or more.
FREE = [(0xFDD0, 0xFDEF), (0xF0000, 0xF00FF)]
JOKER, *MARKS = [chr(c) for first, last in FREE for c in range(first, last + 1)]


def line_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows ``(doc, body, at, line, h, g)``: a line's document (its id and a hash of its text),
    place and two hashes."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    last = F.lit((1 << 63) - 1)
    docs = df.select(
        F.coalesce(F.col(f"`{key}`").cast("long"), last).alias("doc"),
        F.xxhash64(body).alias("body"), body.alias("text"),
    )
    lines = docs.select("doc", "body", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    return lines.where("line <> ''").select(
        "*", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g")
    )


def _part(text: Column, place: Column, size: Column) -> Column:
    return F.substring(text, place + 1, size)


def _pieces(rows: DataFrame, edits: int, choices: list[tuple[int, int, int]]) -> DataFrame:
    """Each row once for each choice of how much shorter the other line is, the segment's number
    from 1 and its shift, with the ``key``, ``place`` and ``size`` of that piece. Choices are
    exploded before anything is computed, which keeps the code of it small.

    A line of ``m`` characters has segments of ``m div (edits + 1)`` characters, the last ones of
    one more where that leaves a rest.
    """
    listed = F.array(*[
        F.struct(F.lit(s).alias("shorter"), F.lit(k).alias("number"), F.lit(d).alias("shift"))
        for s, k, d in choices
    ])
    m, parts = F.col("n") - F.col("shorter"), edits + 1
    each = (
        rows.withColumn("n", F.length("left")).withColumn("c", F.explode(listed))
        .select("*", "c.*").drop("c").where(m >= 0)
        .withColumn("base", F.expr(f"cast((n - shorter) div {parts} as int)"))
        .withColumn("over", F.greatest(F.col("number") - 1 - parts + m % parts, F.lit(0)))
        .withColumn("size", F.col("base") + (F.col("number") > parts - m % parts).cast("int"))
        .withColumn("place", (F.col("number") - 1) * F.col("base") + F.col("over") + F.col("shift"))
        .where("place >= 0 and place + size <= n")
    )
    piece = _part(F.col("left"), F.col("place"), F.col("size"))
    key = F.xxhash64("group", "number", m, piece).alias("key")
    return each.select(key, *rows.columns, "place", "size", "number", "shorter", "base")


def _earlier(edits: int) -> Column:
    """Hashes of the parts that stand for the segments before a piece's own: two lines that agree
    in one of them meet under that segment too. Null for the other segments."""
    parts = edits + 1
    m = F.length("left") - F.col("shorter")
    hashes = []
    for j in range(1, parts):
        # Of the shifts under which segment j is looked up, the least one.
        low = F.greatest(F.lit(1 - j), F.col("shorter") - (parts - j))
        high = F.least(F.lit(j - 1), F.col("shorter") + (parts - j))
        shift = F.least(F.greatest(F.lit(0), low), high)
        over = F.greatest(j - 1 - parts + m % parts, F.lit(0))
        size = F.col("base") + (j > parts - m % parts).cast("int")
        part = _part(F.col("left"), (j - 1) * F.col("base") + over + shift, size)
        hashes.append(F.when(F.col("number") > j, F.xxhash64(part)))
    return F.array(*hashes)


def entries(rows: DataFrame, edits: int) -> DataFrame:
    """Each row once for each of its segments. Rows are ``(group, h, left)``: lines of one
    ``group`` may meet, and ``left`` is what is compared."""
    return _pieces(rows, edits, [(0, k, 0) for k in range(1, edits + 2)])


def probes(rows: DataFrame, edits: int) -> DataFrame:
    """Each row once for each of its substrings that may be a segment of a line that is as long
    or up to ``edits`` characters shorter.

    If the segment is the first that is left unchanged, fewer edits than its number lie before
    it, and no more than the others' number behind it; that leaves few places for it.
    """
    choices = []
    for shorter in range(edits + 1):
        for number in range(1, edits + 2):
            before, behind = number - 1, edits + 1 - number
            shifts = range(max(-before, shorter - behind), min(before, shorter + behind) + 1)
            choices += [(shorter, number, shift) for shift in shifts]
    return _pieces(rows, edits, choices)


def patterns(text: Column, edits: int) -> Column:
    """What ``edits`` jokers can make of a text, each put in somewhere or in place of a character
    that is no mark."""
    marks = F.lit("".join(MARKS))

    def once(x: Column) -> Column:
        put = F.transform(
            F.sequence(F.lit(0), F.length(x)),
            lambda p: F.concat(F.substring(x, F.lit(1), p), F.lit(JOKER), F.substring(x, p + 1, F.length(x))),
        )
        places = F.when(F.length(x) > 0, F.sequence(F.lit(1), F.length(x))).otherwise(F.array())
        plain = F.filter(places, lambda p: ~F.contains(marks, F.substring(x, p, F.lit(1))))
        swapped = F.transform(
            plain,
            lambda p: F.concat(F.substring(x, F.lit(1), p - 1), F.lit(JOKER), F.substring(x, p + 1, F.length(x))),
        )
        return F.array_distinct(F.concat(put, swapped))

    found = F.array(text)
    for _ in range(edits):
        found = F.array_distinct(F.flatten(F.transform(found, once)))
    return found


def by_patterns(rows: DataFrame, edits: int) -> DataFrame:
    """Pairs ``(a, b)`` of each short text and the earliest one of its group that is within the
    edits which both allow; no pair for the earliest itself."""
    each = reduce(DataFrame.unionByName, [
        rows.where(F.col("able") >= e).select(
            "group", "h", "first", "near", F.lit(e).alias("edits"),
            F.explode(patterns(F.col("left"), e)).alias("pattern"),
        ) for e in range(1, edits + 1)
    ])
    same = ["group", "edits", "pattern"]
    least = each.groupBy(*same).agg(
        F.min(F.struct("first", "h")).alias("least"), F.count("*").alias("lines")
    ).where("lines > 1")
    met = each.where("not near").join(least.drop("lines"), same).where(F.col("h") != F.col("least.h"))
    return met.select("h", F.col("least.h").alias("b")).groupBy("h").agg(F.min("b").alias("b")).select(
        F.col("h").alias("a"), "b"
    )


def leftovers(sides: list[DataFrame], crowded: DataFrame, edits: int, round_: int) -> DataFrame:
    """Rows of crowded keys with the piece cut out, the key as their group."""
    behind = F.expr("substring(left, place + size + 1)")
    marks = F.lit(MARKS[round_] * (edits + 1))
    middle = F.col("number").between(2, edits)
    rest = F.concat(_part(F.col("left"), F.lit(0), F.col("place")), F.when(middle, marks).otherwise(""), behind)
    cut = [
        x.join(crowded, "key", "left_semi").select(
            F.col("key").alias("group"), "h", "first", "able", "near", rest.alias("left"),
            F.concat("agreed", _earlier(edits)).alias("agreed"),
        ) for x in sides
    ]
    return reduce(DataFrame.unionByName, cut).distinct()


def thinned(crowd: DataFrame, edits: int, hashes: int) -> tuple[DataFrame, DataFrame]:
    """Pairs ``(a, b)`` of lines near the earliest of their crowd, and the rows that go on."""
    agreed = [F.get(F.col("agreed"), F.lit(k)) for k in range(hashes)]
    # Where all agree in an earlier segment, they meet there; nulls say that there is none.
    apart = reduce(
        Column.__and__, [F.min(x).isNull() | (F.min(x) < F.max(x)) for x in agreed], F.lit(True)
    )
    bits = [c for c in ("bits",) if c in crowd.columns]
    heads = crowd.groupBy("group").agg(
        F.min(F.struct("first", "h", "able", "left", *bits)).alias("head"), apart.alias("apart"),
        F.count("*").alias("lines"),
    ).where("apart and lines > 1").select("group", "head")
    # A line can be in a crowd twice, with two texts left of it.
    met = crowd.join(heads, "group").where("h <> head.h or left <> head.left")
    asked = (F.col("h") != F.col("head.h")) & ~F.col("near")
    if bits:
        asked = asked & alike("bits", "head.bits", edits)
    met = met.withColumn("__e", F.when(asked, F.least("able", "head.able")))
    allowed = F.col("__e")
    sides = {"__a": F.when(allowed > 0, F.col("left")), "__b": F.when(allowed > 0, F.col("head.left"))}
    compared = trimmed(met.withColumns(sides), "__a", "__b")
    near = reduce(
        lambda rest, k: F.when(allowed == k, within(F.col("__a"), F.col("__b"), k)).otherwise(rest),
        range(1, edits + 1), F.lit(False),
    )
    told = written(
        compared.select(*crowd.columns, near.alias("now"), F.col("head.h").alias("b")), "crowd-told"
    )
    pairs = told.where("now").select(F.col("h").alias("a"), "b").distinct()
    # A line with a partner is still one for those behind it, up to the last without one.
    told = told.withColumn("near", F.col("near") | F.col("now"))
    last = told.where("not near").groupBy("group").agg(F.max("first").alias("last"))
    return pairs, told.join(last, "group").where("first <= last").select(*crowd.columns)


#: How crowds are told apart, level by level: characters of a unit, and a number for the hash.
LEVELS = [(2, 0), (1, 0), (2, 1), (1, 1)]


def classes(text: Column, edits: int, unit: int, seed: int) -> Column:
    """For each class of characters or of pairs of neighbouring ones, a number that tells which of
    them a text holds and how often. An edit changes two units of one character or four of two."""
    many = 2 * unit * edits + 1

    def step(state: Column, char: Column) -> Column:
        h = F.xxhash64(F.lit(seed), char) if unit == 1 else F.xxhash64(F.lit(seed), state["last"], char)
        of, weight = F.pmod(h, F.lit(many)), h.bitwiseAND(F.lit((1 << 40) - 1))
        sums = [
            (state[f"c{k}"] + F.when(of == k, weight).otherwise(F.lit(0).cast("bigint"))).alias(f"c{k}")
            for k in range(many)
        ]
        return F.struct(char.alias("last"), *sums)

    zero = F.lit(0).cast("bigint")
    begin = F.struct(F.lit("").alias("last"), *[zero.alias(f"c{k}") for k in range(many)])
    held = F.aggregate(F.split(text, ""), begin, step)
    return F.array(*[held[f"c{k}"] for k in range(many)])


def parity(text: Column) -> Column:
    """64 bits, each told by a pair of neighbouring characters: whether the pairs that tell it are
    odd in number. One edit takes away two pairs at most and adds two, so it changes four bits."""
    def step(state: Column, char: Column) -> Column:
        bit = F.pmod(F.xxhash64(state["last"], char), F.lit(64)).cast("int")
        turned = state["bits"].bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
        return F.struct(char.alias("last"), turned.alias("bits"))

    begin = F.struct(F.lit("").alias("last"), F.lit(0).cast("long").alias("bits"))
    return F.aggregate(F.split(text, ""), begin, step)["bits"]


def alike(a: str, b: str, edits: int) -> Column:
    """Whether parities may be those of texts within the edits."""
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= 4 * edits


def by_parity(rows: DataFrame, edits: int) -> DataFrame:
    """Pairs ``(a, b)`` within each group, told by length and parity; none of two that are both
    near an earlier line. Rows are ``(group, h, near, n, bits)``."""
    other = rows.toDF("group", "b", "settled", "m", "other")
    return rows.join(other, "group").where(
        f"h < b and abs(n - m) <= {edits} and not (near and settled)"
    ).where(alike("bits", "other", edits)).select(F.col("h").alias("a"), "b")


def crowd_of(sides: list[DataFrame], crowded: DataFrame, edits: int) -> tuple[list[DataFrame], DataFrame]:
    """Pairs ``(a, b)`` of lines of crowded keys that agree in a class of each level, and of those
    near the earliest of very many; and the rows that go on, by the classes they agree in."""
    fields = ["h", "first", "able", "near", "left"]
    lines = reduce(DataFrame.unionByName, [
        x.join(crowded, "key", "left_semi").select(*fields) for x in sides
    ]).distinct()
    taken = "[" + "".join(f"{chr(first)}-{chr(last)}" for first, last in FREE) + "]"
    lines = written(
        lines.where(~F.col("left").rlike(taken)).withColumn("bits", parity(F.col("left"))), "crowd-lines"
    )
    none = F.array(*[F.lit(None).cast("bigint")] * edits).alias("agreed")
    rows, found = lines.select("*", F.lit(0).cast("bigint").alias("group"), none), []
    for unit, seed in LEVELS:
        told = rows.withColumn("told", classes(F.col("left"), edits, unit, seed))
        keys = F.array(*[
            F.xxhash64("group", F.lit(k), F.get("told", F.lit(k))) for k in range(2 * unit * edits + 1)
        ])
        each = told.select("h", "near", F.length("left").alias("n"), "bits", F.explode(keys).alias("group"))
        sizes = each.groupBy("group").agg(F.count("*").alias("lines")).where("lines > 1")
        each = written(each.join(sizes, "group"), "crowd-classes")
        few = ["group", "h", "near", "n", "bits"]
        found.append(by_parity(each.where(F.col("lines") <= CROWD).select(*few), edits))
        many = each.where(F.col("lines") > CROWD).groupBy("group", "h").agg(F.min("near").alias("near"))
        many = many.join(lines.drop("near"), "h").select("group", *fields, "bits", none)
        told, on = thinned(written(many, "crowd"), edits, edits)
        found.append(told)
        on = written(on, "crowd-on")
        sizes = on.groupBy("group").agg(F.count("*").alias("lines"))
        on = written(on.join(sizes, "group").withColumn("n", F.length("left")), "crowd-sized")
        found.append(by_parity(on.where(F.col("lines") <= ALIKE).select(*few), edits))
        rows = on.where(F.col("lines") > ALIKE).drop("n", "lines")
        if not rows.limit(1).count():
            break
    return found, rows.drop("bits")


def candidates(rows: DataFrame, edits: int) -> DataFrame:
    """Distinct pairs ``(a, b)`` of hashes of lines that may be near: for each line that is near
    an earlier one, at least one pair with such a line. Rows are ``(group, h, first, able, left)``:
    lines of one ``group`` may meet, ``first`` is their order, ``able`` the edits they allow, and
    ``left`` is what is compared."""
    rows = rows.withColumns({
        "agreed": F.array().cast("array<bigint>"), "near": F.lit(False),
    })
    found, round_ = [], 0
    while True:
        # The lines themselves are not shuffled unless their segment is crowded.
        long = rows.where(F.length("left") > TINY) if round_ else rows
        held = entries(rows.where(F.length("left") > TINY - edits) if round_ else rows, edits)
        asked = probes(long, edits)
        if round_:
            found.append(by_patterns(rows.where(F.length("left") <= TINY), edits))
        crowded = written(
            held.groupBy("key").agg(F.count("*").alias("lines")).where(F.col("lines") > CROWD)
            .select("key"), "crowded",
        )
        any_crowd = crowded.limit(1).count()
        a = held.select("key", F.col("h").alias("b"), *([F.col("near").alias("nb")] if round_ else []))
        b = asked.select("key", F.col("h").alias("a"), *([F.col("near").alias("na")] if round_ else []))
        if any_crowd:
            a, b = (x.join(crowded, "key", "left_anti") for x in (a, b))
        pairs = b.join(a, "key").where("a <> b and not (na and nb)" if round_ else "a <> b")
        found.append(
            pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        )
        if not any_crowd:
            break
        round_ += 1
        if round_ == 1:
            shared, rows = crowd_of([held, asked], crowded, edits)
            found += shared
        else:
            crowd = written(leftovers([held, asked], crowded, edits, round_), "crowd")
            told, on = thinned(crowd, edits, edits * round_)
            found.append(told)
            rows = written(on, "crowd-on")
        if not rows.limit(1).count():
            break
    return reduce(DataFrame.unionByName, found).distinct()


def within(a: Column, b: Column, edits: int) -> Column:
    """Whether two texts are within ``edits`` edits, by a banded bit-parallel automaton.

    Bit ``o`` of word ``e`` says that the first ``j`` characters of ``a`` can be turned into the
    first ``j - edits + o`` of ``b`` with ``e`` edits. A character moves all diagonals at once:
    where it is the next one of ``b`` the bit stays, one edit more lets every bit stay, move to
    the diagonal below, or, within the same step, to the one above.
    """
    band = (1 << (2 * edits + 1)) - 1

    def close(words: list[Column]) -> list[Column]:
        out = [words[0]]
        for w in words[1:]:
            fewer = out[-1]
            out.append(
                w.bitwiseOR(fewer).bitwiseOR(F.shiftleft(fewer, 1)).bitwiseAND(F.lit(band))
            )
        return out

    def step(state: Column, char: Column) -> Column:
        same = reduce(
            Column.bitwiseOR,
            [F.when(F.get(state["other"], state["j"] - edits + o) == char, F.lit(1 << o))
             .otherwise(F.lit(0)) for o in range(2 * edits + 1)],
        )
        old = [state[f"w{e}"] for e in range(edits + 1)]
        new = [old[0].bitwiseAND(same)]
        for e in range(1, edits + 1):
            new.append(
                old[e].bitwiseAND(same).bitwiseOR(old[e - 1]).bitwiseOR(F.shiftright(old[e - 1], 1))
            )
        words = [w.alias(f"w{e}") for e, w in enumerate(close(new))]
        return F.struct((state["j"] + 1).alias("j"), state["other"].alias("other"), *words)

    start = close([F.lit(1 << edits)] + [F.lit(0)] * edits)
    # The other text's characters travel in the state, or they would be split at each step.
    begin = F.struct(
        F.lit(0).alias("j"), F.split(b, "").alias("other"),
        *[w.alias(f"w{e}") for e, w in enumerate(start)],
    )
    final = F.aggregate(F.split(a, ""), begin, step)
    last = F.length(b) - F.length(a) + edits
    reached = F.call_function("shiftright", final[f"w{edits}"], last).bitwiseAND(F.lit(1)) == 1
    near = F.abs(F.length(a) - F.length(b)) <= edits
    return F.when((a == "") | ~near, near).otherwise(reached)


def _common(a: str, b: str, most: str, side: str) -> Column:
    """Length of the longest common beginning (``left``) or end (``right``), ``most`` at most,
    by whole comparisons of halving steps."""
    steps = ", ".join(str(1 << k) for k in range(30, -1, -1))
    return F.expr(f"""
        aggregate(filter(array({steps}), s -> s <= {most}), 0,
          (p, s) -> if(p + s <= {most} and {side}({a}, p + s) = {side}({b}, p + s), p + s, p))""")


def trimmed(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cuts off what two texts have in common at the beginning and then at the end. That changes
    no edit distance, and leaves little of texts that differ in one place."""
    shorter = f"least(length({a}), length({b}))"
    df = df.withColumn("__p", _common(a, b, shorter, "left"))
    df = df.withColumn("__s", _common(a, b, f"({shorter} - __p)", "right"))
    # Not folded into one expression, which would hold each of them many times.
    middle = "substring({0}, __p + 1, length({0}) - __p - __s)"
    return df.withColumns({a: F.expr(middle.format(a)), b: F.expr(middle.format(b))}).drop("__p", "__s")


def plausible(a: Column, b: Column, edits: Column, pieces: int = 8) -> Column:
    """False only for texts that are not within ``edits`` edits: an edit spoils one piece of a
    text at most, and all other pieces have to occur in the other text."""
    size = F.ceil(F.length(a) / pieces).cast("int")
    missing = [
        (~F.contains(b, _part(a, size * k, size))).cast("int") for k in range(pieces)
    ]
    return reduce(Column.__add__, missing) <= edits


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", edits: int = EDITS,
          chars_per_edit: int = CHARS_PER_EDIT, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Replaces the text by what is left of it and adds ``n_lines`` and ``n_removed``.

    Columns of these names are replaced. Null texts become empty.
    """
    lines = line_rows(df, key, text)
    order = F.struct("doc", "body", "at")
    firsts = written(
        lines.groupBy("h", "g").agg(F.min(order).alias("first"), F.count("*").alias("rows")),
        "first-lines",
    )
    copied = small(
        written(firsts.where("rows > 1").select("h", "g", "first"), "copied"), broadcast_rows
    )
    # The first occurrences, with their texts; most lines occur once and are not shuffled.
    unique = lines.join(copied, ["h", "g"], "left").where(
        F.col("first").isNull() | (F.col("first") == order)
    )
    able = F.least(F.floor(F.length("line") / chars_per_edit), F.lit(edits))
    rows = unique.where(F.length("line") >= chars_per_edit).select(
        F.lit(0).cast("long").alias("group"), "h", order.alias("first"),
        able.cast("int").alias("able"), F.col("line").alias("left"),
    )
    pairs = written(candidates(rows, edits), "line-pairs")
    wanted = small(
        written(
            pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct(), "wanted"
        ), broadcast_rows,
    )
    texts = written(
        unique.join(wanted, "h", "left_semi").select(
            "h", order.alias("first"), "line", able.alias("able"),
            parity(F.col("line")).alias("bits"),
        ), "line-texts",
    )
    # Most pairs go by their parities, before their texts are brought together.
    bits = texts.select("h", "bits")
    pairs = pairs.join(bits.toDF("a", "pa"), "a").join(bits.toDF("b", "pb"), "b").where(
        alike("pa", "pb", edits)
    ).select("a", "b")
    texts = texts.drop("bits")
    one = texts.select(*[F.col(c).alias(x) for c, x in zip(texts.columns, ("a", "fa", "la", "ka"))])
    two = texts.select(*[F.col(c).alias(x) for c, x in zip(texts.columns, ("b", "fb", "lb", "kb"))])
    met = pairs.join(one, "a").join(two, "b")
    met = met.where(plausible(F.col("la"), F.col("lb"), F.least("ka", "kb")))
    # What is left of both begins and ends with an edit each, so the inner part has two fewer.
    inner = F.expr(f"substring(la, {edits + 1}, length(la) - {2 * edits})")
    inside = plausible(inner, F.col("lb"), F.lit(max(0, edits - 2)))
    met = written(trimmed(met, "la", "lb"), "line-middles")
    met = met.where((F.length("la") <= 2 * edits) | inside)
    # Fewer edits than the greatest number are told by a narrower band.
    allowed = F.least("ka", "kb")
    are_near = reduce(
        lambda rest, k: F.when(allowed == k, within(F.col("la"), F.col("lb"), k)).otherwise(rest),
        range(1, edits + 1), F.lit(False),
    )
    later = F.greatest("fa", "fb")
    near = written(met.where(are_near).select(later.alias("first")).distinct(), "near-lines")
    left = firsts.select("first").join(near, "first", "left_anti")
    places = left.select(
        F.col("first.doc").alias("__doc"), F.col("first.body").alias("__body"), "first.at"
    ).groupBy("__doc", "__body").agg(
        F.array_sort(F.collect_list("at")).alias("__places")
    )
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    names = (text, "n_lines", "n_removed")
    kept = [c for c in df.columns if c not in names]
    docs = df.select(
        *[F.col(f"`{c}`") for c in kept], F.split(body, "\n").alias("__lines"),
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit((1 << 63) - 1)).alias("__doc"),
        F.xxhash64(body).alias("__body"),
    )
    own = F.coalesce("__places", F.array().cast("array<int>"))
    full = F.size(F.filter("__lines", lambda x: x != ""))
    chosen = F.when(F.size(own) == full, F.col("__lines")).otherwise(
        F.transform(own, lambda k: F.get("__lines", k))
    )
    rebuilt = F.array_join(chosen, "\n")
    return docs.join(places, ["__doc", "__body"], "left").select(
        *[F.col(f"`{c}`") for c in kept], rebuilt.alias(text), full.cast("long").alias("n_lines"),
        (full - F.size(own)).cast("long").alias("n_removed"),
    )
