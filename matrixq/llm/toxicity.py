"""Toxicity by noisy-channel deobfuscation: disguised words are restored, then texts are scored.

Three things are learned. A character model, trigram counts of the words of all texts, says how
words are spelled. A lexicon, from labelled rows, has the words that occur in far more toxic texts
than chance allows, with their weights. A text's score is the logistic of the prior and the
weights of the lexicon's words that it holds.

Before a text is scored, tokens that may be words in disguise are restored. A token is a lattice
of characters: a letter may stand for itself, a digit or sign for the letters it resembles or for
nothing, a repeated letter for nothing, and letters set apart by blanks may be one word or more.
Viterbi decoding finds the most likely spelling under the character model and the costs of these
changes. Only tokens whose lattice holds a word of the lexicon are decoded, as no other token can
change a score; that is told by skeletons, in which all that may be confused is one symbol, and by
going through their beginnings with each sign both read and left out.

Null and empty texts hold no words and get the prior. Without labels of both kinds the prior is
their mean, or 0. Repeated rows score alike. Labels are used only where the caller says so, and
nothing but the text goes into a score.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matrixq.llm.common import written
from matrixq.session import tune_texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: About so many labelled texts, chosen by a hash of their id, does the lexicon learn from at most:
#: the bound of the sample. Their words are counted in Spark.
LABELLED_TEXTS = 50_000
#: A word is taken into the lexicon if it is in this many toxic texts, a likelihood-ratio test
#: against chance gives at least that statistic, and it has at least this weight.
LEAST_TEXTS, LEAST_EVIDENCE, LEAST_WEIGHT = 5, 24.0, 1.5
THRESHOLD = 0.3

#: Letters that a sign may stand for (fixed values).
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c",
}
#: Costs, in nats: of a letter read from a sign, of a sign left out that resembles a letter and
#: stands inside a word or outside, of any other sign or a repeated letter left out, of a blank left out between single letters, of
#: one kept.
READ, UNREAD, OUTSIDE, LEFT_OUT, REPEATED, JOINED, PARTED = 1.0, 8.0, 3.5, 2.0, 1.5, 0.2, 2.0
#: Weight of each lexicon word in the character model, as a share of all words.
LEXICON_SHARE = 0.002
#: A run of single characters set apart by blanks.
_SPACED = re.compile(r"(?<!\S)\S(?:[ \t]+\S){2,}(?!\S)")
_EDGE = "^"
_SIGNS = "".join(c for c in map(chr, range(128)) if not c.isalnum())
_KEPT_TOKENS = 150_000
_TEXTS_AT_ONCE = 500


def ends_of(token: str) -> tuple[int, int]:
    """Where the first letter or digit of any script stands, and the place behind the last."""
    if token.isascii():
        return len(token) - len(token.lstrip(_SIGNS)), len(token.rstrip(_SIGNS))
    begin, end = 0, len(token)
    while begin < end and not token[begin].isalnum():
        begin += 1
    while end > begin and not token[end - 1].isalnum():
        end -= 1
    return begin, end


def bare(token: str) -> str:
    """The token without signs of any script around it and without characters that do not show.

    Marks that belong to its last letter stay.
    """
    if token.isascii():
        return token.strip(_SIGNS)
    shown = "".join(c for c in token if unicodedata.category(c) != "Cf")
    begin, end = ends_of(shown)
    while begin < end < len(shown) and unicodedata.category(shown[end])[0] == "M":
        end += 1
    return shown[begin:end]


def words_in(text: str) -> list[str]:
    """The letters of tokens, without signs around them, in lower case."""
    return [w for t in text.lower().split() if (w := bare(t))]


class Spelling:
    """Trigram model of words of a-z; other letters are one symbol."""

    def __init__(self, counts: dict[int, int], lexicon: Iterable[str]) -> None:
        table = np.full((28, 28, 28), 0.02)
        for code, n in counts.items():
            table[code // 784, code // 28 % 28, code % 28] += n
        each = LEXICON_SHARE * table[27, 27].sum()  # every word begins once
        for word in lexicon:
            s = [27, 27, *(ord(c) - 97 if "a" <= c <= "z" else 26 for c in word), 27]
            for x, y, z in zip(s, s[1:], s[2:]):
                table[x, y, z] += each
        self.cost = (-np.log(table / table.sum(2, keepdims=True))).tolist()


def count_trigrams(texts: list[str]) -> np.ndarray:
    """Trigrams of all words of some texts, with edges: two before a word and one behind."""
    table = np.full(256, 26, np.uint8)
    table[97:123] = np.arange(26)
    table[[9, 10, 11, 12, 13, 32]] = 27
    raw = np.frombuffer(b"  " + " ".join(texts).lower().encode() + b" ", np.uint8)
    s = table[raw].astype(np.int32)
    codes = s[:-2] * 784 + s[1:-1] * 28 + s[2:]
    # Where a word begins, what stands before the edge does not matter.
    begins = (s[1:-1] == 27) & (s[2:] != 27)
    codes = np.where(begins, 27 * 784 + 27 * 28 + s[2:], codes)
    return np.bincount(codes[begins | (s[1:-1] != 27)], minlength=28**3)


#: What may be confused becomes one letter.
_ALIKE = {**{c: x[0] for c, x in LOOKS.items()}, "l": "i", "g": "b", "9": "b"}
_REPEATS = re.compile(r"(.)\1+")


def skeleton(word: str) -> str:
    """The word with all that may be confused made equal and without repetitions."""
    return _REPEATS.sub(r"\1", "".join(_ALIKE.get(c, c) for c in word))


class Model:
    """What scoring needs; small, so that it travels with the tasks."""

    def __init__(self, trigrams: dict[int, int], weights: dict[str, float], prior: float) -> None:
        self.trigrams, self.weights, self.prior = trigrams, weights, prior
        self.ready = False

    def prepare(self) -> Model:
        if not self.ready:
            self.spelling = Spelling(self.trigrams, sorted(self.weights))
            # Decoding gives letters only.
            self.skeletons = {skeleton(w) for w in self.weights if w.isalpha()}
            self.begins = {x[:k] for x in self.skeletons for k in range(1, len(x) + 1)}
            self.clean: set[str] = set()
            self.ready = True
        return self

    def decode(self, token: str) -> list[str]:
        """The likeliest words of a token's lattice.

        A state is the last two letters of the word so far and the character read last, which
        tells repetitions; it keeps the least cost and the way there.
        """
        cost = self.spelling.cost
        edge = 27
        best: dict[tuple, tuple[float, tuple]] = {(edge, edge, ""): (0.0, ())}
        inside = range(*ends_of(token))
        for at, c in enumerate(token):
            step: dict[tuple, tuple[float, tuple]] = {}

            def offer(state: tuple, price: float, way: tuple) -> None:
                if state not in step or step[state][0] > price:
                    step[state] = (price, way)

            letter = ord(c) - 97 if "a" <= c <= "z" else 26
            for (p, q, last), (price, way) in best.items():
                if c == " ":
                    offer((p, q, last), price + JOINED, way)
                    if q != edge:
                        offer((edge, edge, ""), price + PARTED + cost[p][q][edge], (way, " "))
                    continue
                if c.isalpha():
                    offer((q, letter, c), price + cost[p][q][letter], (way, c))
                    if last == c:
                        offer((p, q, c), price + REPEATED, way)
                else:
                    left_out = LEFT_OUT if c not in LOOKS else UNREAD if at in inside else OUTSIDE
                    offer((p, q, last), price + left_out, way)
                for x in LOOKS.get(c, ""):
                    k = ord(x) - 97
                    offer((q, k, x), price + READ + cost[p][q][k], (way, x))
                    if last == x:
                        offer((p, q, x), price + REPEATED, way)
            best = step
        ends = [
            (price + (cost[p][q][edge] if q != edge else 0.0), way)
            for (p, q, _), (price, way) in best.items()
        ]
        if not ends:
            return []
        way, out = min(ends, key=lambda x: x[0])[1], []
        while way:
            way, c = way
            out.append(c)
        return "".join(reversed(out)).split()

    def may_hold(self, token: str) -> bool:
        """Whether the token's lattice holds a word of the lexicon, but for what looks alike.

        Kept are the beginnings of skeletons that some reading of the token so far gives. As in
        ``decode``, any sign may be left out by itself, and a word may end at each blank.
        """
        if token.isalpha():
            return skeleton(token) in self.skeletons
        states = {""}
        for c in token:
            if c == " ":
                if not self.skeletons.isdisjoint(states):
                    return True
                states.add("")
            elif c.isalpha() or c in LOOKS:
                x = _ALIKE.get(c, c)
                step = {p if p[-1:] == x else p + x for p in states}
                step &= self.begins
                states = step | states if c in LOOKS else step
                if not states and " " not in token:
                    return False
        return not self.skeletons.isdisjoint(states)

    def restored(self, token: str) -> list[str]:
        """The words of a token (in lower case), restored if it may be a word in disguise."""
        plain = words_in(token)
        if plain and plain[0] in self.weights:
            return plain
        return self.decode(token) if self.may_hold(token) else plain

    def apart(self, text: str) -> list[str]:
        """Words of letters that are set apart by blanks."""
        out = []
        for run in _SPACED.findall(text):
            letters = re.sub(r"[ \t]+", " ", run)
            if self.may_hold(letters):
                out += self.decode(letters)
        return out

    def held(self, text: str) -> set[str]:
        """The words of the lexicon that the text holds, open or in disguise."""
        low, found = text.lower(), set()
        for token in set(low.split()) - self.clean:
            own = self.weights.keys() & self.restored(token)
            if own:
                found |= own
            elif len(token) <= 64:
                if len(self.clean) >= _KEPT_TOKENS:
                    self.clean.clear()
                self.clean.add(token)
        return found | (self.weights.keys() & self.apart(low))

    def score(self, text: str | None) -> float:
        """The prior and the weights of all lexicon words of the text, each once."""
        total = self.prior + sum(self.weights[w] for w in sorted(self.held(text or "")))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, total))))


def learn_trigrams(texts: DataFrame, text: str) -> dict[int, int]:
    """Trigram counts of all texts: 22,000 numbers, however many texts."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t for t in batch["text"] if t]
            for k in range(0, len(texts), _TEXTS_AT_ONCE):
                total = count_trigrams(texts[k : k + _TEXTS_AT_ONCE])
                code = np.flatnonzero(total)
                yield pd.DataFrame({"code": code, "n": total[code]})

    counts = texts.select(F.col(f"`{text}`").alias("text")).mapInPandas(count, "code long, n long")
    rows = counts.groupBy("code").agg(F.sum("n").alias("n")).collect()
    return {r["code"]: r["n"] for r in rows}


def learn_weights(labelled: DataFrame) -> tuple[dict[str, float], float]:
    """The lexicon and the prior from rows ``(place, words, label)``, a text and its distinct words.

    A word's weight is the logarithm of how much likelier it is in a toxic text. The prior is that
    of texts that hold no word of the lexicon.
    """
    rows = labelled.select("place", "words", F.col("label").cast("int").alias("y"))
    sums = rows.agg(F.count("*").alias("n"), F.sum("y").alias("toxic")).first()
    toxic, clean = sums["toxic"] or 0, sums["n"] - (sums["toxic"] or 0)
    if not toxic or not clean:
        return {}, 30.0 if toxic else -30.0
    words = rows.select(F.explode("words").alias("word"), "y").groupBy("word").agg(
        F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")
    )
    t, c = F.col("t"), F.col("c")
    weight = F.log((t + 0.5) / (toxic + 1)) - F.log((c + 0.5) / (clean + 1))
    share = toxic / (toxic + clean)
    evidence = 2 * (t * F.log(t / ((t + c) * share))
                    + F.when(c > 0, c * F.log(c / ((t + c) * (1 - share)))).otherwise(0.0))
    lexicon = (
        words.where(t >= LEAST_TEXTS).withColumn("w", weight).withColumn("evidence", evidence)
        .where((F.col("w") >= LEAST_WEIGHT) & (F.col("evidence") >= LEAST_EVIDENCE))
    )
    # No more words than the labelled texts' distinct words over LEAST_TEXTS.
    lexicon = written(lexicon.select("word", "w"), "lexicon")
    weights = {r["word"]: r["w"] for r in lexicon.collect()}
    marked = rows.select("place", F.explode("words").alias("word")).join(
        lexicon.select("word"), "word", "left_semi"
    ).select("place").distinct()
    rest = rows.join(marked, "place", "left_anti").agg(
        F.count("*").alias("n"), F.sum("y").alias("t")
    ).first()
    t, c = (rest["t"] or 0) + 0.5, rest["n"] - (rest["t"] or 0) + 0.5
    return weights, math.log(t / c)


def learn(texts: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
          label: str = "toxic", at_most: int = LABELLED_TEXTS) -> Model:
    """The model of ``labels`` (rows of ``key`` and ``label``) over ``texts``."""
    tune_texts(texts.sparkSession)
    chosen = labels.where(f"`{label}` is not null and `{key}` is not null").select(
        F.col(f"`{key}`").alias("__key"), F.col(f"`{label}`").alias("label")
    ).groupBy("__key").agg(F.max("label").alias("label"))
    share = min(1.0, at_most / max(1, chosen.count()))
    some = chosen.where(F.pmod(F.xxhash64("__key"), F.lit(1 << 20)) < share * (1 << 20))

    @F.pandas_udf("array<string>")
    def distinct_words(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            yield pd.Series([sorted(set(words_in(t or ""))) for t in values])

    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    found = texts.select(F.col(f"`{key}`").alias("__key"), body.alias("text")).join(
        F.broadcast(some), "__key"  # at_most rows of 16 bytes or so
    )
    read = written(
        found.select(F.xxhash64("text").alias("hash"), "label", distinct_words("text").alias("words"),
                     F.monotonically_increasing_id().alias("place")), "labelled",
    )
    # Copies of a text are one piece of evidence.
    once = read.groupBy("hash").agg(F.max("label").alias("label"), F.min("place").alias("place"))
    labelled = read.select("place", "words").join(F.broadcast(once), "place")
    weights, prior = learn_weights(labelled)
    return Model(learn_trigrams(texts, text), weights, prior)


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Adds the score, 0 to 1; a column of that name is replaced."""
    tune_texts(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # a lexicon and 22,000 counts at most

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ready = shared.value.prepare()
        for texts in batches:
            yield texts.map(ready.score)

    return df.withColumn(out, scored(F.col(f"`{text}`")))


def held_out(key: Column) -> Column:
    """Rows that no label is learned from: a quarter, by the checksum of the id as text."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def restore(df: DataFrame, model: Model, text: str = "text", out: str = "restored") -> DataFrame:
    """Adds the words of each text, in lower case, with words in disguise restored."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def restored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ready = shared.value.prepare()

        def one(value: str | None) -> str:
            low = (value or "").lower()
            tokens = [" ".join(ready.restored(t)) for t in low.split()]
            return " ".join([*filter(None, tokens), *ready.apart(low)])

        for texts in batches:
            yield pd.Series([one(t) for t in texts])

    return df.withColumn(out, restored(F.col(f"`{text}`")))
