from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from agrilake.llm.queries import _vocabulary
from agrilake.llm.tokens import WordEncoder

WORD, BYTE = _vocabulary("word_bpe_49k.json"), _vocabulary("byte_bpe_50k.json")
KINDS = [(WORD, False), (BYTE, True)]


@cache
def _plain(path: str) -> Tokenizer:
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    return plain


@cache
def _encoder(path: str, joined: bool) -> WordEncoder:
    return WordEncoder(path, joined)


@pytest.mark.parametrize(("path", "joined"), KINDS)
def test_a_word_is_asked_for_once_whatever_follows_it(path, joined):
    encoder = WordEncoder(path, joined)
    encoder.encode(["so anbleg anbleg, anbleg. anbleg;\nmor\nmor! anbleg: anbleg"])
    words = [p.strip() for p in encoder.known.young if "anbleg" in p or "mor" in p]
    assert sorted(words) == ["anbleg", "mor"]


@pytest.mark.parametrize(("path", "joined"), KINDS)
def test_columns_in_pieces_equal_the_plain_tokenizer(path, joined):
    texts = [None, "", "a" * 50, "One, two.\nThree\n\nfour", "x\0y z", "\nÉté. \n u.\n", "e≠. á.b Å, İ.x ς. Σ.", "12.5kg 'tis\xa0\ny don't."]
    column = pa.array(["out", *texts, "out"]).slice(1, len(texts))
    expected = [_plain(path).encode(t or "", add_special_tokens=False).ids for t in texts]
    encoder = WordEncoder(path, joined)
    encoder.together = 20
    for _ in range(2):
        assert [ids.tolist() for ids in encoder.encode_column(column)] == expected


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("aéÉsT' \n\t\r\0.,!5\xa0́İ字-", max_size=14), max_size=5))
def test_any_texts_equal_the_plain_tokenizer(texts):
    for path, joined in KINDS:
        encoder = _encoder(path, joined)
        expected = [_plain(path).encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(ids, "<u2").tolist() for ids in encoder.encode(texts)] == expected
