import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids_of(model, texts):
    return [[int.from_bytes(b[i : i + 4], "little") for i in range(0, len(b), 4)] for b in model.encode(texts)]


TEXTS = [
    "", " ", "a", "  ", "a  b", " a", "a ", "\n\n", "tab\t\tz ", "▁", "a▁b ▁▁c", "café   x", "中文 \U0001f600\U0001f600", "é",
    "<s>", "</s> <unk> <0x0A>", "\x00\x01", "a" * 5000, "1234567890" * 300, " " * 5000 + "x", "the " * 900, "=-" * 2500,
    "﻿​ z", "hahahaha" * 400, "x" + " " * 17 + "y" + " " * 33,
]


@pytest.mark.parametrize("text", TEXTS)
def test_hard_texts_equal_the_library(text):
    model = pieces.load(PATH)
    (ids,) = ids_of(model, [text])
    assert ids == LIBRARY.encode(text)
    assert model.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'▁.<>sdmtrehaigX7  é中"), st.characters(exclude_categories=["Cs"])), max_size=50), max_size=6))
def test_any_texts_equal_the_library(texts):
    model = pieces.load(PATH)
    assert ids_of(model, texts) == LIBRARY.encode(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([0, 1, 2, 3 + 0xE2, 3 + 0x96, 3 + 0x81, 3 + 0xF0, 259, 28705]), st.integers(0, 31999)), max_size=12))
def test_any_ids_decode_like_the_library(ids):
    assert pieces.load(PATH).decode(ids) == LIBRARY.decode(ids)


def test_rounds_and_the_queue_agree(monkeypatch):
    """The same words by merge rounds alone, and each by itself in order of rank."""
    words = ["▁" + w for w in ("there", "ababababa", "aaaaaaaaaaa", "   ".replace(" ", "▁"), "internationalisation", "é中x")]
    model = pieces.PieceBPE(PATH)
    by_rounds = model.encode_words(words)
    monkeypatch.setattr(pieces, "LONG", 0)
    assert model.encode_words(words) == by_rounds


def test_the_memo_is_bounded_and_cuts_of_the_words_change_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "MEMO_WORDS", 5)
    monkeypatch.setattr(pieces, "CHARS", 7)
    model = pieces.PieceBPE(PATH)
    texts = ["one two three four five six", "seven eight " + "x" * 100, "one two"] * 3
    for text in texts:
        assert ids_of(model, [text]) == [LIBRARY.encode(text)]
        assert len(model.memo) <= 5 and "x" * 100 not in model.memo
    assert ids_of(model, texts) == LIBRARY.encode(texts)


def test_a_model_that_normalises_is_refused(tmp_path):
    data = open(PATH, "rb").read()
    path = tmp_path / "other.model"
    path.write_bytes(data + b"\x1a\x04\x12\x02ab")  # a normaliser with a character map
    with pytest.raises(ValueError):
        pieces.read_model(str(path))


def test_query_equals_the_library(spark):
    got = {r.doc_id: r for r in queries.op13_merge_rounds(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = LIBRARY.encode(d.text or "")
        row = got[d.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


def test_nulls_repeats_clashing_columns_and_empty_tables(spark):
    docs = spark.createDataFrame(
        [(1, None, 5, "x"), (None, "a b", 6, "y"), (2, "", 7, None), (2, "", 7, None)], "doc_id long, text string, ids int, decoded string"
    )
    rows = pieces.decode_documents(pieces.encode_documents(docs, PATH), PATH).collect()
    assert sorted((r.doc_id or 0, r.text) for r in rows) == [(0, "a b"), (1, ""), (2, ""), (2, "")]
    assert pieces.encode_documents(docs.limit(0), PATH).collect() == []
