"""Exact BPE encoding by backtracking over longest matches, decoding by an offset table.

The tokenizer file is JSON of the tokenizers library: a BPE model whose units are bytes, the
last unit of a word carrying the end-of-word suffix. A word is encoded in time linear in its
length: an Aho-Corasick pass finds the longest token at each place, and a token is appended only
if the pair with the token before it is one that merging would leave apart. Otherwise the next
shorter token at that place is tried, and where none fits the encoder steps back once; every
place is given up at most once. Words are encoded once per worker and looked up afterwards.

Decoding gathers the bytes of all tokens of a text from one buffer by their offsets, with a space
between tokens, as the library does for a file without decoder.

Nulls count as empty texts; an empty text has no tokens and decodes to an empty text. Strings of
special tokens in a text become those tokens. Other columns are kept untouched. Letters, numbers
and lower case follow the Unicode tables of this Python and of ``regex``; they differ from the
library's only in characters assigned after Unicode 15.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matrixq.session import tune_texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a tokenizer file; it is broadcast, so larger files are refused.
MAX_FILE_BYTES = 64 << 20
#: Words kept per worker, and the longest word kept. Others are encoded whenever they occur.
KEPT_WORDS, KEPT_LENGTH = 200_000, 64
#: Texts given back at a time; their ids and what they decode to are in memory together.
TEXTS_OUT = 500
#: Tokens decoded at a time.
DECODE_CHUNK = 1 << 18


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Tables:
    """What encoding and decoding need, from the text of a tokenizer file.

    Tokens are numbered by the order of their merges, base units first: 0 to 255 inner bytes, 256
    to 511 last bytes of words. A token's units are characters of the same numbers, so that words
    and tokens are ordinary strings.
    """

    def __init__(self, file_text: str) -> None:
        spec = json.loads(file_text)
        model, end = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab = model["vocab"]
        letters = byte_letters()
        names = letters + [c + end for c in letters]
        order = {name: k for k, name in enumerate(names)}
        self.units = [chr(k) for k in range(512)]
        self.parts: list[tuple[int, int] | None] = [None] * 512
        self.merged: dict[tuple[int, int], int] = {}
        for pair in model["merges"]:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b = order[left], order[right]
            token = order.setdefault(left + right, len(names))
            if token == len(names):
                names.append(left + right)
                self.units.append(self.units[a] + self.units[b])
                self.parts.append((a, b))
                self.merged[a, b] = token
        self.ids = np.array([vocab[name] for name in names], "<u4")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        known = {**vocab, **self.special}
        spelled = [b""] * (max(known.values()) + 1)
        for name, token in known.items():
            spelled[token] = name.encode() + b" "
        self.offsets = np.concatenate([[0], np.cumsum([len(x) for x in spelled])])
        self.buffer = np.frombuffer(b"".join(spelled), "u1")
        self.pattern = self._pattern(spec["pre_tokenizer"])
        self.ready = False

    @staticmethod
    def _pattern(spec: dict) -> str:
        """The pattern of words; blanks are Unicode's, as in the library's engine."""
        split = next(x for x in spec["pretokenizers"] if x["type"] == "Split")
        return split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")

    def prepare(self) -> Tables:
        """Builds on the worker what need not travel."""
        if self.ready:
            return self
        self.length = [len(u) for u in self.units]
        self.compatible: dict[int, bool] = {}
        token_of = {u: k for k, u in enumerate(self.units)}
        self.shorter = [
            next((token_of[u[:k]] for k in range(len(u) - 1, 0, -1) if u[:k] in token_of), -1)
            for u in self.units
        ]
        automaton = ahocorasick.Automaton()
        for token, units in enumerate(self.units):
            if token < 512 or self.merge_slowly(units) == [token]:
                automaton.add_word(units, token)
        automaton.make_automaton()
        self.automaton = automaton
        self.find_words = regex.compile(self.pattern).findall
        self.find_special = regex.compile(
            "|".join(f"({regex.escape(s)})" for s in self.special) or r"(?!)"
        )
        self.cache: dict[str, bytes] = {}
        self.ready = True
        return self

    def merge_slowly(self, units: str) -> list[int]:
        """Merging by the rule itself: the earliest merge first, from left to right."""
        tokens = [ord(u) for u in units]
        while len(tokens) > 1:
            found = [self.merged.get(pair, sys.maxsize) for pair in zip(tokens, tokens[1:])]
            k = found.index(best := min(found))
            if best == sys.maxsize:
                break
            tokens[k : k + 2] = [best]
        return tokens

    def fits(self, left: int, right: int) -> bool:
        """Whether merging leaves the two tokens apart when they stand side by side."""
        key = left << 32 | right
        known = self.compatible.get(key)
        if known is None:
            known = self.compatible[key] = self._stays_apart(left, right)
        return known

    def _stays_apart(self, left: int, right: int) -> bool:
        """Undoes the two tokens' merges from the last one, watching the units at the seam.

        At each moment the seam has one token on either side. Had the two been merged before the
        next of the undone merges took place, the tokens could not have come about. A merge of
        the left token wins a tie, as equal pairs are merged from left to right.
        """
        before = sys.maxsize
        while True:
            if self.merged.get((left, right), sys.maxsize) < before:
                return False
            if left > right:
                if self.parts[left] is None:
                    return True
                before, left = left, self.parts[left][1]
            else:
                if self.parts[right] is None:
                    if self.parts[left] is None:
                        return True
                    before, left = left, self.parts[left][1]
                else:
                    before, right = right + 1, self.parts[right][0]

    def encode_units(self, units: str) -> list[int]:
        n, length, shorter = len(units), self.length, self.shorter
        longest = [0] * n
        for last, token in self.automaton.iter(units):
            longest[last - length[token] + 1] = token  # later ends are longer
        open_at = bytearray(b"\x01") * (n + 1)
        tokens: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + length[token]
            if open_at[end] and (not tokens or self.fits(tokens[-1], token)):
                tokens.append(token)
                if (at := end) == n:
                    return tokens
                token = longest[at]
                continue
            token = shorter[token]
            while token < 0:  # nothing fits here: the token before has to be a shorter one
                open_at[at] = 0
                token = tokens.pop()
                at -= length[token]
                token = shorter[token]

    def encode_word(self, word: str) -> bytes:
        raw = word.encode()
        units = raw[:-1].decode("latin-1") + chr(256 + raw[-1])
        found = self.ids[self.encode_units(units)].tobytes()
        if len(word) <= KEPT_LENGTH:
            if len(self.cache) >= KEPT_WORDS:
                self.cache.clear()
            self.cache[word] = found
        return found

    def encode_plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        cache, encode = self.cache.get, self.encode_word
        return b"".join([cache(w) or encode(w) for w in self.find_words(text.lower())])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not any(s in text for s in self.special):
            return self.encode_plain(text)
        out, at = [], 0
        for found in self.find_special.finditer(text):
            out.append(self.encode_plain(text[at : found.start()]))
            out.append(np.array([self.special[found.group()]], "<u4").tobytes())
            at = found.end()
        return b"".join([*out, self.encode_plain(text[at:])])

    def decode(self, ids: bytes) -> str:
        all_ids, out = np.frombuffer(ids, "<u4"), []
        for k in range(0, len(all_ids), DECODE_CHUNK):
            some = all_ids[k : k + DECODE_CHUNK].astype(np.int64)
            first, sizes = self.offsets[some], self.offsets[some + 1] - self.offsets[some]
            ends = np.cumsum(sizes)
            places = np.repeat(first - ends + sizes, sizes) + np.arange(ends[-1])
            out.append(self.buffer[places].tobytes())
        return b"".join(out)[:-1].decode()


def read_tables(spark: SparkSession, path: str) -> Tables:
    """The tokenizer file at ``path`` on the driver; its size is checked before it travels."""
    with open(path, encoding="utf-8") as file:
        text = file.read(MAX_FILE_BYTES + 1)
    if len(text) > MAX_FILE_BYTES:
        raise ValueError(f"a tokenizer file may have {MAX_FILE_BYTES} bytes")
    return Tables(text)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids",
           decoded: str | None = None) -> DataFrame:
    """Adds ``ids``, binary of little-endian 32-bit token ids, and the ``decoded`` text if named.

    An existing column of such a name is replaced.
    """
    spark = df.sparkSession
    tune_texts(spark)
    shared = spark.sparkContext.broadcast(read_tables(spark, path))
    fields = "ids binary" + (", decoded string" if decoded else "")

    @F.pandas_udf(fields)
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tables = shared.value.prepare()
        for texts in batches:
            for k in range(0, len(texts), TEXTS_OUT):
                found = [tables.encode(t) if t else b"" for t in texts[k : k + TEXTS_OUT]]
                out = {"ids": found}
                if decoded:
                    out["decoded"] = [tables.decode(x) if x else "" for x in found]
                yield pd.DataFrame(out)

    kept = [c for c in df.columns if c not in (ids, decoded)]
    both = df.select(*[F.col(f"`{c}`") for c in kept], encoded(F.col(f"`{text}`")).alias("__bpe"))
    out = [F.col("__bpe.ids").alias(ids)]
    if decoded:
        out.append(F.col("__bpe.decoded").alias(decoded))
    return both.select(*[F.col(f"`{c}`") for c in kept], *out)
