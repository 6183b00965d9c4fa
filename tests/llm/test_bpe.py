import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


TEXTS = [
    "", " ", "a", "\n\n", "a\n\nb", "x  y", "tab\t\tz ", "don't we'll I'M !'s", "café   x", "中文 \U0001f600\U0001f600",
    "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "jq'jq \x1c'x \x85y", "a" * 5000, "1234567890" * 300,
    " " * 2000 + "x", "ßſ'ſ", "é'é 'S", "\x00\x01'\x01", " 'x  y", "﻿​ z",
]


@pytest.mark.parametrize("text", TEXTS)
def test_hard_texts_equal_the_library(library, text):
    own = bpe.load(PATH)
    ids = own.ids(text).tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'!,.<|>sdmtrevlqjzX7  é中"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text_equals_the_library(text):
    library = Tokenizer.from_file(PATH) if not hasattr(test_any_text_equals_the_library, "t") else test_any_text_equals_the_library.t
    test_any_text_equals_the_library.t = library
    own = bpe.load(PATH)
    assert own.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert b"".join(own.fragments(text.encode())) == text.encode()


def test_the_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_FRAGMENTS", 3)
    memo = bpe._Memo(lambda s: [ord(c) for c in s])
    for word in ("a", "b", "c", "d", "x" * 100):
        assert memo[word.encode()] == memo[word.encode()]
    assert len(memo) <= 3 and b"x" * 100 not in memo


def test_broken_ids_decode_like_the_library(library):
    for ids in ([176], [158, 220], [50256, 176, 64]):
        assert bpe.load(PATH).decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_query_equals_the_library(spark, library):
    got = {r.doc_id: r for r in queries.op8_bpe_forced_boundaries(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        row = got[d.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_nulls_repeats_clashing_columns_and_empty_tables(spark):
    docs = spark.createDataFrame(
        [(1, None, 5, "x"), (None, "a b", 6, "y"), (2, "", 7, None), (2, "", 7, None)], "doc_id long, text string, ids int, decoded string"
    )
    rows = bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH).collect()
    assert sorted((r.doc_id or 0, r.text) for r in rows) == [(0, "a b"), (1, ""), (2, ""), (2, "")]
    assert bpe.encode_documents(docs.limit(0), PATH).collect() == []
