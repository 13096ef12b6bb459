"""Tokens and decoded text against the tokenizer itself, text by text."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmart.llm import bpe

TOKENIZER = bpe._tokenizer(bpe.default_vocabulary())


def want(text):
    ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids
    return ids, TOKENIZER.decode(ids, skip_special_tokens=False)


def test_like_the_tokenizer(docs, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_WORDS", 50)
    got = {}
    for key, tokens, decoded in bpe.encode_decode(docs).collect():
        got.setdefault(key, []).append((np.frombuffer(tokens, "<u4").tolist(), decoded))
    rows = docs.select("doc_id", "text").collect()
    assert sum(map(len, got.values())) == len(rows)
    for key, text in rows:
        assert want(text) in got[key]


def test_empty_table(no_docs):
    assert bpe.token_digests(bpe.encode_decode(no_docs)).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_words_alone_give_the_ids_of_the_text(text):
    """Encoding by words between white space, and by pieces within, loses nothing."""
    codes, ids = bpe._Codes(), []
    numbers = [c for s in text.encode("utf-8", "ignore").split() for c in codes[s]]
    words = list(codes.words)
    for c in numbers:
        ids += TOKENIZER.encode(words[c], add_special_tokens=False).ids
    assert ids == want(text.encode("utf-8", "ignore").decode())[0]


@pytest.mark.parametrize("codes", [[], [0], [1, 2**31, 70000]])
def test_packing(codes):
    assert bpe._unpacked(bpe._packed(codes)).tolist() == codes
