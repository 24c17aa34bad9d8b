import random

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from statuta.llm.token_count import PairMerger, byte_symbols, count_tokens

from .data import AWKWARD, documents, text

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both():
    return PairMerger(PATH, P.PATTERN), Tokenizer.from_file(PATH)


def test_byte_symbols_cover_all_bytes():
    assert sorted(byte_symbols().values()) == list(range(256)) and len(byte_symbols()) == 256


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_equals_library(both, s):
    assert both[0].count(s) == len(both[1].encode(s, add_special_tokens=False).ids)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab 's\n\t<|endoftext|>é ", max_size=80))
def test_special_strings_and_white_space(both, s):
    assert both[0].count(s + "<|endoftext|>" + s) == len(both[1].encode(s + "<|endoftext|>" + s, add_special_tokens=False).ids)


def test_query(spark, both):
    rng = random.Random(1)
    rows = [*AWKWARD, (7, text(rng, 400)), (8, "a" * 20_000), (9, "<|endoftext|> b")]
    docs = documents(spark, rows).selectExpr("*", "1 as n_tokens")
    got = sorted(map(tuple, count_tokens(docs, PATH, P.PATTERN).collect()), key=str)
    want = [(i, len((t or "").encode()), n := len(both[1].encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in rows]
    assert got == sorted(want, key=str)
    assert count_tokens(docs.where("false"), PATH, P.PATTERN).count() == 0


def test_long_text_is_split_lazily(both):
    s = "wort und \n satz " * 80_000
    assert both[0].count(s) == len(both[1].encode(s, add_special_tokens=False).ids)
