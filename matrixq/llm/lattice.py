"""Language-model scores by subword lattices.

A text is its words, A-Z in lower case, and one end. A word's subword probability is the sum over
all ways to cut it into pieces of an existing vocabulary, each way weighing the product of its
pieces' weights: the forward recursion over the lattice of all cuts gives it in log space, without
listing them. The vocabulary stays as it is. Its scores are negative ranks, so a piece of rank
``r`` starts with a weight proportional to ``1 / (r + RANK_OFFSET)``; characters without a piece
are cut into bytes. ``ROUNDS`` passes of expectation maximisation over the distinct words of the
training texts then fit the weights, with those first weights as prior.

Words of the training texts are arcs of the lattice as well, over the whole word, with their
discounted frequencies; what the discount leaves is the weight of the ways through the pieces. So
a token's probability is ``max(c - D, 0) / N + D * V / N * subwords``. That is done for each class
of training texts (by language, say), backed by the frequencies of all classes; the class of a
text to be scored is not asked for, as the probabilities of all classes are added up, each
with its share of the training texts. Since no arc crosses a blank, the forward recursion
over a text is the product of those over its tokens, so each distinct word of the corpus goes
through the lattice once.

Words are counted within tasks before they are shuffled. The most frequent words, ``HEAD`` at the
most, are sent to every task and looked up there; the rest of each text's words is joined by a
shuffle, where no word can be hot as all those are among the head. The classes are the
``CLASSES`` most frequent ones, all others count together as one.

Null texts count as empty: one end. Repeated rows each count and all get the same scores. Without
training texts the base score is 0 for each token, and the subwords alone decide. Empty tables
give no rows.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matrixq.llm.common import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Weight of a piece of rank r before training: 1 / (r + RANK_OFFSET); rounds of training; rows'
#: worth of the first weights that are added to each round's counts, for each piece.
RANK_OFFSET, ROUNDS, PRIOR = 2.7, 2, 0.01
#: Classes told apart, and words sent to every task with the most bytes of one.
CLASSES, HEAD, HEAD_BYTES = 8, 1 << 18, 64
#: Characters in the lattices at hand, distinct words a task counts before it hands them on.
AT_HAND, COUNTED = 100_000, 400_000
#: Distinct words of texts, one after the other, that are looked up together.
LOOKED_UP = 200_000
#: Longer words are trained on in stretches of this many characters, and scored place by place.
STRETCH = 4096
END = b""
BEGIN = "▁"  # the sign that vocabularies have before a word
BREAK = 10  # between words of a lattice; no word holds it


@dataclass(frozen=True)
class Vocabulary:
    """Pieces, then the 256 bytes, with the log weights that their ranks give."""

    pieces: list[str]
    weights: np.ndarray

    @staticmethod
    def read(path: str) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        kinds = (model.is_byte, model.is_control, model.is_unknown, model.is_unused)
        pieces = [
            (model.id_to_piece(k), -model.get_score(k)) for k in range(model.vocab_size())
            if not any(kind(k) for kind in kinds) and model.get_score(k) > -1e8
        ]
        if BEGIN not in dict(pieces):  # a word's begin alone is a piece in any case
            pieces.append((BEGIN, max(r for _, r in pieces)))
        ranks = np.array([r for _, r in pieces])
        weights = 1 / (np.append(ranks, np.full(256, ranks.max())) + RANK_OFFSET)
        return Vocabulary([p for p, _ in pieces], np.log(weights / weights.sum()))


class Lattice:
    """The lattices of many words at a time."""

    def __init__(self, pieces: list[str]) -> None:
        self.automaton = ahocorasick.Automaton()
        for k, piece in enumerate(pieces):
            self.automaton.add_word(piece, k)
        self.automaton.make_automaton()
        self.sizes = np.array([len(p) for p in pieces])
        self.single = np.array([ord(p) for p in pieces if len(p) == 1], np.uint32)
        self.pieces = len(pieces)

    def arcs(self, words: list[str]) -> None:
        """Finds all arcs of the words, each begun by the sign for a word's begin."""
        joined = "".join(f"{BEGIN}{w}\n" for w in words)
        signs = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        sizes = np.array([len(w) + 2 for w in words])
        self.first = np.cumsum(sizes) - sizes
        self.last = self.first + sizes - 1
        hits = chain.from_iterable(self.automaton.iter(joined))
        ends, piece = np.fromiter(hits, np.int64).reshape(-1, 2).T
        starts = ends - self.sizes[piece] + 1
        bare = np.flatnonzero(~np.isin(signs, self.single) & (signs != BREAK))
        # A character without a piece is one arc for all of its bytes.
        kinds, self.kind = np.unique(signs[bare], return_inverse=True)
        self.bytes = np.zeros((len(kinds), 256))
        for row, sign in enumerate(kinds.tolist()):
            for byte in chr(sign).encode():
                self.bytes[row, byte] += 1
        self.starts, self.ends = np.append(starts, bare), np.append(ends, bare) + 1
        self.piece, self.n_signs = piece, len(signs)
        self.word = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(signs)) - self.first[self.word]
        # Both sweeps add up the ways along the arcs place by place, all words together.
        self.place, self.home = place, None
        self.onward = self._order(self.starts, self.ends, place[self.ends - 1])

    def scores(self, weights: np.ndarray) -> np.ndarray:
        of_bytes = self.bytes @ weights[self.pieces:]
        return np.append(weights[:self.pieces][self.piece], of_bytes[self.kind])

    @staticmethod
    def _order(come: np.ndarray, go: np.ndarray, turn: np.ndarray) -> tuple:
        """The arcs in the order of their turns, where each turn begins, and where each run of
        arcs to one place begins within it."""
        # Turn, place and number of an arc as one number: words at hand are short enough for that.
        bits = len(go).bit_length()
        packed = (turn - turn.min()) * (go.max() + 1) + go << bits | np.arange(len(go))
        packed.sort()
        order = packed & (1 << bits) - 1
        come, go, turn = come[order], go[order], turn[order]
        fresh = np.append(True, turn[1:] != turn[:-1])
        cuts = np.append(np.flatnonzero(fresh), len(turn))
        runs = np.flatnonzero(fresh | np.append(True, go[1:] != go[:-1]))
        return order, come, go[runs], cuts, np.searchsorted(runs, cuts), runs

    def forward(self, scores: np.ndarray) -> np.ndarray:
        """Log probability of all ways to each place."""
        return self._sweep(self.first, self.onward, scores)

    def backward(self, scores: np.ndarray) -> np.ndarray:
        """Log probability of all ways from each place to the end of its word."""
        if self.home is None:
            self.home = self._order(self.ends, self.starts, -self.place[self.starts])
        return self._sweep(self.last, self.home, scores)

    def _sweep(self, begin: np.ndarray, arcs: tuple, scores: np.ndarray) -> np.ndarray:
        order, come, to, cuts, first_run, runs = arcs
        ways = np.full(self.n_signs + 1, -np.inf)
        ways[begin] = 0
        scores = scores[order]
        turns = zip(cuts[:-1].tolist(), cuts[1:].tolist(), first_run[:-1].tolist(), first_run[1:].tolist())
        for a, b, r, s in turns:
            ways[to[r:s]] = np.logaddexp.reduceat(ways[come[a:b]] + scores[a:b], runs[r:s] - a)
        return ways

    def marginals(self, words: list[str], weights: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of each word under each of the weights."""
        out = np.empty((len(words), len(weights)))
        for rows in _chunks(words):
            some = [words[r] for r in rows]
            if len(some[0]) > STRETCH:
                out[rows] = [[self.marginal(some[0], w) for w in weights]]
                continue
            self.arcs(some)
            for k, w in enumerate(weights):
                out[rows, k] = self.forward(self.scores(w))[self.last]
        return out

    def marginal(self, word: str, weights: np.ndarray) -> float:
        """The same for one long word, place by place, holding the last few places only."""
        word = BEGIN + word
        reach = int(self.sizes.max())
        ways = [0.0] + [-math.inf] * reach  # ways[d]: to the place d characters back
        single = set(self.single.tolist())
        hits = self.automaton.iter(word)
        hit = next(hits, None)
        for at, sign in enumerate(word):
            come = []
            while hit is not None and hit[0] == at:
                come.append(ways[self.sizes[hit[1]] - 1] + weights[hit[1]])
                hit = next(hits, None)
            if ord(sign) not in single:
                come.append(ways[0] + sum(weights[self.pieces + b] for b in sign.encode()))
            most = max(come)
            ways = [most + math.log(sum(math.exp(c - most) for c in come)), *ways[:reach]]
        return ways[0]

    def expected(self, words: list[str], weights: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the words, each counted once."""
        out = np.zeros(self.pieces + 256)
        cut = [w[k:k + STRETCH] for w in words for k in range(0, len(w), STRETCH)]
        for rows in _chunks(cut):
            self.arcs([cut[r] for r in rows])
            scores = self.scores(weights)
            there, back = self.forward(scores), self.backward(scores)
            whole = there[self.last][self.word[self.starts]]
            share = np.exp(there[self.starts] + scores + back[self.ends] - whole)
            known = len(self.piece)
            out[:self.pieces] += np.bincount(self.piece, share[:known], minlength=self.pieces)
            out[self.pieces:] += np.bincount(self.kind, share[known:], len(self.bytes)) @ self.bytes
        return out


def _chunks(words: list[str]) -> Iterator[list[int]]:
    """Places of words of like length, so many that their lattices stay small; a word longer
    than a stretch alone."""
    order = sorted(range(len(words)), key=lambda r: len(words[r]))
    rows, held = [], 0
    for r in order:
        size = len(words[r]) + 2
        if rows and (held + size > AT_HAND or len(words[r]) > STRETCH):
            yield rows
            rows, held = [], 0
        rows.append(r)
        held += size
    if rows:
        yield rows


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Lists of ``width`` numbers each, as rows."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)


def _lists(rows: np.ndarray) -> pa.ListArray:
    """The other way round."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(rows).reshape(-1)))


def held_out(key: Column) -> Column:
    """Whether the id's checksum says that the row is no training row."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def tokens_of(body: bytes) -> Counter[bytes]:
    """Words and the end of a text. Bytes are split at ASCII blanks and lower-cased for A-Z."""
    found = Counter(body.lower().split())
    found[END] += 1
    return found


@dataclass(frozen=True)
class Counts:
    """Tokens of a set of training texts: all, distinct, discount, and texts."""

    tokens: int
    types: int
    discount: float
    texts: int

    @staticmethod
    def of(tokens: int, types: int, ones: int, twos: int, texts: int) -> Counts:
        d = ones / (ones + 2 * twos) if ones else 0.5
        return Counts(tokens, types, min(max(d, 0.1), 0.9), texts)

    def arc(self, c: np.ndarray) -> np.ndarray:
        """Log weight of the arc over a token seen ``c`` times."""
        with np.errstate(divide="ignore"):
            return np.log(np.maximum(c - self.discount, 0) / max(1, self.tokens))

    @property
    def left(self) -> float:
        """Log weight of all else."""
        return math.log(self.discount * self.types / self.tokens) if self.tokens else 0.0


@dataclass(frozen=True)
class Model:
    """Distinct tokens with ``all``, ``c`` and the natural log probability in each class."""

    tokens: DataFrame
    counts: Counts
    shares: list[float]


def count_tokens(df: DataFrame, key: str, text: str, of_class: Column) -> DataFrame:
    """Rows ``(token, class, n, c)``: occurrences in all texts and in training texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str | None, Counter[bytes]] = {}
        texts: Counter[str | None] = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            for kind, found in seen.items():
                found[END] += texts[kind]
                ns = pa.array(list(found.values()), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    pa.array(list(found), pa.binary()), pa.array([kind] * len(found), pa.string()),
                    ns, ns if kind is not None else pa.array([0] * len(found), pa.int64()),
                ], names=["token", "class", "n", "c"])

        for batch in batches:
            for body, kind in zip(batch.column(0), batch.column(1).to_pylist()):
                seen.setdefault(kind, Counter()).update(body.as_py().lower().split())
                texts[kind] += 1
                if sum(map(len, seen.values())) >= COUNTED:
                    yield from out()
                    seen.clear()
                    texts.clear()
        yield from out()

    # Texts that are not trained on have no class.
    kind = F.when(~held_out(F.col(f"`{key}`")), F.coalesce(of_class.cast("string"), F.lit("")))
    bodies = df.select(
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("body"), kind.alias("class")
    )
    counted = bodies.mapInArrow(count, "token binary, class string, n long, c long")
    return counted.groupBy("token", "class").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))


def learn(df: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text",
          of_class: str | None = None) -> Model:
    """Counts all tokens, fits the weights of the pieces for each class, and scores each distinct
    token. Training texts are those not ``held_out``."""
    kind = F.lit("") if of_class is None else F.col(f"`{of_class}`")
    counted = written(count_tokens(df, key, text, kind), "tokens")
    sizes = counted.where("class is not null").groupBy("class").agg(F.sum("c").alias("c"))
    classes = [r["class"] for r in sizes.orderBy(F.desc("c"), "class").limit(CLASSES).collect()]
    # One more class for all others, if there are any.
    if sizes.limit(CLASSES + 1).count() > CLASSES:
        classes = [*classes[:-1], None]
    named = [c for c in classes if c is not None]

    def in_class(c: str | None) -> Column:
        here = F.col("class") == c if c is not None else ~F.col("class").isin(named)
        return F.coalesce(F.sum(F.when(here, F.col("c"))), F.lit(0)).cast("long")

    each = [in_class(c) for c in classes]
    tokens = written(
        counted.groupBy("token").agg(
            F.sum("n").alias("n"), F.sum("c").alias("c"),
            F.array(*each).cast("array<bigint>").alias("cs"),
        ), "distinct-tokens",
    )

    def counts(c: Column) -> Column:
        end = F.col("token") == F.lit(END)
        return F.struct(
            F.coalesce(F.sum(c), F.lit(0)).alias("tokens"), F.count_if(c > 0).alias("types"),
            F.count_if(c == 1).alias("ones"), F.count_if(c == 2).alias("twos"),
            F.coalesce(F.sum(F.when(end, c)), F.lit(0)).alias("texts"),
        )

    row = tokens.agg(
        counts(F.col("c")).alias("all"),
        *[counts(F.col("cs")[k]).alias(f"of{k}") for k in range(len(classes))],
    ).first()
    whole = Counts.of(*row["all"])
    kinds = [Counts.of(*row[f"of{k}"]) for k in range(len(classes))]
    weights = fitted(tokens, vocabulary, len(classes))
    sent = df.sparkSession.sparkContext.broadcast(vocabulary.pieces)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(sent.value)
        for batch in batches:
            words = [t.decode() for t in batch.column("token").to_pylist()]
            # The end has the subword weight of one type among all, and words the rest.
            word_share = math.log((whole.types + 1) / (whole.types + 2))
            sub = lattice.marginals(words, weights) + word_share
            sub[[k for k, w in enumerate(words) if not w]] = -math.log(whole.types + 2)
            c = batch.column("c").to_numpy()
            general = np.logaddexp(whole.arc(c)[:, None], whole.left + sub)
            cs = _matrix(batch.column("cs"), len(kinds)).astype(float)
            for k, kind in enumerate(kinds):
                general[:, k] = np.logaddexp(kind.arc(cs[:, k]), kind.left + general[:, k])
            yield pa.RecordBatch.from_arrays([
                batch.column("token"), batch.column("n"), batch.column("c"),
                _lists(general),
            ], names=["token", "n", "c", "logs"])

    scored = tokens.mapInArrow(score, "token binary, n long, c long, logs array<double>")
    shares = [k.texts / whole.texts for k in kinds] or [1.0]
    return Model(written(scored, "token-scores"), whole, shares)


def fitted(tokens: DataFrame, vocabulary: Vocabulary, classes: int) -> list[np.ndarray]:
    """Log weights of the pieces for each class, one set if there is no class. Runs a job a round;
    what comes to the driver is a number for each piece and class."""
    weights = [vocabulary.weights] * max(1, classes)
    size = len(vocabulary.weights)
    sent = tokens.sparkSession.sparkContext.broadcast(vocabulary.pieces)
    for _ in range(ROUNDS if classes else 0):
        now = weights

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice, totals = Lattice(sent.value), np.zeros((classes, size))
            for batch in batches:
                words = [t.decode() for t in batch.column("token").to_pylist()]
                cs = _matrix(batch.column("cs"), classes)
                for k in range(classes):
                    some = [words[r] for r in np.flatnonzero(cs[:, k] > 0).tolist()]
                    totals[k] += lattice.expected(some, now[k])
            k, piece = np.nonzero(totals)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k, pa.int32()), pa.array(piece, pa.int32()), pa.array(totals[k, piece])],
                names=["k", "piece", "x"],
            )

        parts = tokens.where("c > 0").select("token", "cs").mapInArrow(
            expect, "k int, piece int, x double"
        )
        found = parts.groupBy("k", "piece").agg(F.sum("x").alias("x")).toArrow()
        counts = np.tile(PRIOR * size * np.exp(vocabulary.weights), (classes, 1))
        counts[found["k"].to_numpy(), found["piece"].to_numpy()] += found["x"].to_numpy()
        weights = list(np.log(counts / counts.sum(1, keepdims=True)))
    return weights


def head_of(tokens: DataFrame) -> DataFrame:
    """The most frequent tokens, ``HEAD`` at the most. Runs a job that counts tokens by the
    size of their frequency; which are taken changes no score."""
    step = F.floor(8 * F.log2("n")).cast("int")
    short = tokens.where(F.length("token") <= HEAD_BYTES)
    found = short.groupBy(step.alias("step")).count().collect()
    room, least = HEAD, None
    for r in sorted(found, key=lambda r: -r["step"]):
        room -= r["count"]
        if room < 0:
            break
        least = r["step"]
    return short.where(F.lit(False) if least is None else step >= least)


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(key, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one for each
    row of ``df``. Scores are base-10 logarithms."""
    classes = len(model.shares)
    head = head_of(model.tokens).toArrow()
    places = {token: k for k, token in enumerate(head["token"].to_pylist())}
    seen, each = head["c"].to_numpy(), np.array(head["logs"].to_pylist()).reshape(-1, classes)
    total = model.counts.tokens + model.counts.types + 1
    # By token: whether it is known, its base score, and its logarithm in each class.
    table = np.column_stack([seen > 0, np.log10((seen + 1) / total), each])
    sent = df.sparkSession.sparkContext.broadcast((places, table))
    fields = ["id", "body", "token", "n", "known", "base", "logs"]
    schema = "id long, body long, token binary, n long, known long, base double, logs array<double>"

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row with the sums over a text's frequent tokens, and one for each other token."""
        places, table = sent.value
        def sums_of(rows: pa.RecordBatch, tokens: list[bytes], times: list[int],
                    sizes: list[int]) -> Iterator[pa.RecordBatch]:
            at = np.fromiter(map(places.get, tokens, repeat(-1)), np.int64, len(tokens))
            n, row = np.array(times, np.int64), np.repeat(np.arange(len(sizes)), sizes)
            met, other = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
            sums = np.zeros((len(sizes), table.shape[1] + 1))
            values = table[at[met]] if len(met) else np.zeros((0, table.shape[1]))
            for k, column in enumerate([np.ones(len(met)), *values.T]):
                sums[:, k] = np.bincount(row[met], column * n[met], len(sizes))
            yield pa.RecordBatch.from_arrays([
                rows.column(0), rows.column(1), pa.nulls(len(sizes), pa.binary()),
                pa.array(sums[:, 0].astype(np.int64)), pa.array(sums[:, 1].astype(np.int64)),
                pa.array(sums[:, 2]), _lists(sums[:, 3:]),
            ], names=fields)
            if len(other):
                of, blank = pa.array(row[other]), len(other)
                yield pa.RecordBatch.from_arrays([
                    rows.column(0).take(of), rows.column(1).take(of),
                    pa.array([tokens[k] for k in other.tolist()], pa.binary()), pa.array(n[other]),
                    pa.nulls(blank, pa.int64()), pa.nulls(blank, pa.float64()),
                    pa.nulls(blank, pa.list_(pa.float64())),
                ], names=fields)

        for batch in batches:
            first, tokens, times, sizes = 0, [], [], []
            for k, body in enumerate(batch.column(2)):
                found = tokens_of(body.as_py())
                tokens.extend(found)
                times.extend(found.values())
                sizes.append(len(found))
                if len(tokens) >= LOOKED_UP or k == batch.num_rows - 1:
                    yield from sums_of(batch.slice(first, len(sizes)), tokens, times, sizes)
                    first, tokens, times, sizes = k + 1, [], [], []

    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    docs = df.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.xxhash64(body).alias("body"),
        body.cast("binary").alias("bytes"),
    )
    looked = written(docs.mapInArrow(look_up, schema), "token-sums")
    rare = looked.where("token is not null").select("id", "body", "token", "n")
    met = rare.join(model.tokens.select("token", "c", "logs"), "token")
    n = F.col("n")
    late = met.select(
        "id", "body", n, F.when(F.col("c") > 0, n).otherwise(0).alias("known"),
        (n * F.log10((F.col("c") + 1) / F.lit(float(total)))).alias("base"),
        F.transform("logs", lambda x: x * n).alias("logs"), F.lit(0).alias("rows"),
    )
    early = looked.where("token is null").select(
        "id", "body", "n", "known", "base", "logs", F.lit(1).alias("rows")
    )
    sums = early.unionByName(late).groupBy("id", "body").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.sum("known").alias("known"),
        F.sum("base").alias("base"),
        *[F.sum(F.col("logs")[k]).alias(f"log{k}") for k in range(classes)],
    )
    ways = F.array(*[
        F.col(f"log{k}") / F.col("rows") + math.log(share) if share else F.lit(-math.inf)
        for k, share in enumerate(model.shares)
    ])
    each = sums.withColumn("ways", ways).withColumn("most", F.array_max("ways"))
    added = F.aggregate("ways", F.lit(0.0), lambda t, w: t + F.exp(w - F.col("most")))
    # Rows with equal id and text were summed together; each is given out.
    return each.select(
        F.col("id").alias(key), held_out(F.col("id")).alias("held_out"),
        F.expr("n div rows").alias("n_tokens"), F.expr("known div rows").alias("n_known"),
        F.lit(model.counts.tokens).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("rows")).alias("base_score"),
        ((F.col("most") + F.log(added)) / math.log(10)).alias("score"),
        F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))).alias("copy"),
    ).drop("copy")
