import hashlib

import numpy as np
import public_tokenizers
import pytest
from helpers import documents, as_tables
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barloom.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def numbers(packed):
    return np.frombuffer(packed, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_text_as_the_library(texts):
    own = bpe.vocabulary(PATH)
    expected = [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    packed = own.encode(texts)
    assert [numbers(p) for p in packed] == expected
    assert own.decode(packed) == [LIBRARY.decode(i, skip_special_tokens=False) for i in expected]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["aa", "th", "e", "er", " ", "  ", "\n", "'s", "1", "the", "é", "<|endoftext|>", "."]), max_size=40))
def test_repeated_pieces_as_the_library(parts):
    text = "".join(parts)
    assert numbers(bpe.vocabulary(PATH).encode([text])[0]) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_every_code_point_splits_as_the_library():
    texts = ["".join(f"a{chr(c)}1" for c in range(k, k + 256) if not 0xD800 <= c < 0xE000) for k in range(0, 0x110000, 256)]
    own = bpe.vocabulary(PATH).encode(texts)
    for text, packed in zip(texts, own, strict=True):
        assert numbers(packed) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_small_caches_and_pieces_change_nothing(monkeypatch):
    text = "The quick brown fox, thethethe 12345 jumps! " * 400
    expected = bpe.vocabulary(PATH).encode([text, text[:50]])
    for name in ("CACHED_WORDS", "WORDS_AT_ONCE", "LONG_TEXT"):
        monkeypatch.setattr(bpe, name, 7)
    assert bpe.Vocabulary(PATH).encode([text, text[:50]]) == expected


def test_decoding_unknown_ids_and_broken_utf8():
    ids = np.array([162, 60000, 64], "<u4").tobytes()
    assert bpe.vocabulary(PATH).decode([ids, None, b""]) == ["\ufffda", "", ""]


def test_table_with_odd_rows(spark, monkeypatch):
    frame = documents(spark).selectExpr("*", "1 as n_tokens", "2 as other", "array(1) as ids")
    encoded = bpe.encode(frame, PATH)
    assert encoded.columns == ["doc_id", "text", "source", "other", "ids", "n_tokens"]
    decoded = bpe.decode(encoded, PATH).collect()
    assert len(decoded) == frame.count()
    for row in decoded:
        assert row.decoded == (row.text or "")
        assert numbers(row.ids) == LIBRARY.encode(row.text or "", add_special_tokens=False).ids
        assert row.n_tokens == len(row.ids) // 4
    as_tables(monkeypatch, queries, documents=documents(spark))
    for row, made in zip(decoded, queries.op1_bpe(spark, "").collect(), strict=True):
        assert made.ids_sha256 == hashlib.sha256(row.ids).hexdigest()
        assert made.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()


@pytest.mark.parametrize("name", ["op1_bpe", "op4_token_counts"])
def test_empty_table(spark, monkeypatch, name):
    as_tables(monkeypatch, queries, documents=documents(spark, []))
    assert queries.QUERIES[name](spark, "").collect() == []
