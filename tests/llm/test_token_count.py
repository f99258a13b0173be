"""Operator 10 against the tokenizer library."""
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from claimlens.llm import token_count as tc

PATH = public_tokenizers.path(tc.TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=12), st.sampled_from(
    ["<|endoftext|>", "<|endoftext|", "  ", "\n\n", " the", "'s", "12345", "naïve", "日本語", "🙂", " ", "aaaa" * 9])),
    max_size=8).map("".join))
def test_counts_equal_the_library(text):
    assert tc._counter(PATH).tokens(text) == len(Tokens.library.encode(text, add_special_tokens=False).ids)


class Tokens:
    library = Tokenizer.from_file(PATH)


def test_one_very_long_word(library):
    for text in ("ab" * 20_000, "\n" * 5_000, "x" * 9_999 + "é" * 77):
        assert tc._counter(PATH).merged(text) == len(library.encode(text).ids)


def test_long_texts_are_walked(library, monkeypatch):
    monkeypatch.setattr(tc, "_LONG", 10)
    text = "Some words, and more words, in a longer text."
    assert tc._counter(PATH).tokens(text) == len(library.encode(text).ids)


def test_rows(docs_of, library):
    texts = [None, "", "a", "<|endoftext|>", "tie", "tie", "é" * 600, "long " * 30_000]
    got = tc.token_counts(docs_of([(i, t) for i, t in enumerate(texts)] + [(None, "tie"), (4, "tie")]))
    for r in got.collect():
        t = texts[r.doc_id if r.doc_id is not None else 4] or ""
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 512)
    assert got.count() == 10
    assert tc.token_counts(docs_of([])).collect() == []
