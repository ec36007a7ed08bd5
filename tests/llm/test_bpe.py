import json
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from matrixq.llm import bpe
from matrixq.llm.queries import WORD_TOKENIZER
from tests.llm.conftest import ODD_TEXTS


@pytest.fixture(scope="module")
def tables():
    with open(WORD_TOKENIZER, encoding="utf-8") as file:
        return bpe.Tables(file.read()).prepare()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_TOKENIZER)


def same(tables, library, text):
    ids = tables.encode(text)
    expected = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == expected
    assert (tables.decode(ids) if ids else "") == library.decode(expected, skip_special_tokens=False)


def test_equals_library_on_random_words(tables, library):
    rng = random.Random(7)
    for _ in range(400):
        same(tables, library, "".join(rng.choices("aabcdeehilnorstt' .,1!\n", k=rng.randint(1, 60))))


def test_equals_library_on_repetitions_and_specials(tables, library):
    for text in ("a" * 999, "the" * 400, "don't we'll 's", "x<|endoftext|>y <|startoftext|>",
                 "İSTANBUL ΣΑΣ ς Å", "</w> a</w>", "\x1c a\x85b\xa0c"):
        same(tables, library, text)


def test_backtracking_equals_merging(tables):
    rng = random.Random(3)
    for _ in range(300):
        word = "".join(rng.choices("abehnorstz", k=rng.randint(1, 25)))
        units = word[:-1] + chr(256 + ord(word[-1]))
        assert tables.encode_units(units) == tables.merge_slowly(units)


def test_every_token_is_its_own_encoding(tables):
    assert all(tables.merge_slowly(u) == [k] for k, u in enumerate(tables.units))


def test_odd_rows(odd, library):
    rows = bpe.encode(odd, WORD_TOKENIZER, decoded="decoded").select("doc_id", "text", "ids", "decoded", "n").collect()
    assert len(rows) == len(ODD_TEXTS) and {r["n"] for r in rows} == {"n"}
    for r in rows:
        expected = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == expected
        assert r["decoded"] == library.decode(expected, skip_special_tokens=False)


def test_empty_table(nothing):
    assert bpe.encode(nothing, WORD_TOKENIZER).count() == 0


def test_file_is_json():
    with open(WORD_TOKENIZER, encoding="utf-8") as file:
        assert json.load(file)["model"]["type"] == "BPE"
