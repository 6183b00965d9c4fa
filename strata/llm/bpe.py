"""Byte-pair encoding by forced boundaries, and decoding.

A byte pair that no vocabulary token holds is a certain cut: no merge can cross it,
so the pieces on its two sides are encoded apart and their ids concatenated.  Most
cuts fall before the blanks, hence fragments recur and are encoded once per worker
(a bounded memo), whatever the length of the text.

Cuts also have to leave the pre-tokenizer's splits as they are.  Its pattern looks
ahead only after white space and treats an apostrophe specially, so a cut must have
an ASCII byte other than white space on its left, and not an apostrophe after a sign.

Texts: null and empty ones have no ids.  The tokenizer's special strings inside a
text are special ids, as the library has it.  Repeated rows are encoded each.
"""

from __future__ import annotations

import base64
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import ids_and_texts

# Fixed value: the splitting pattern of byte-level BPE tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO_FRAGMENTS = 300_000
MEMO_BYTES = 64  # longer fragments are encoded each time
ROWS = 256  # rows taken from an Arrow batch at once
_SEPARATOR = b"\xff"  # in no UTF-8 text


def _byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def certain_cuts(tokens: list[bytes]) -> np.ndarray:
    """For each byte pair (left * 256 + right): whether a text may be cut inside it."""
    inside = np.zeros((256, 256), bool)
    for token in tokens:
        a = np.frombuffer(token, np.uint8)
        inside[a[:-1], a[1:]] = True
    cuts = ~inside
    cuts[128:] = False
    blank = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32]
    cuts[blank] = False
    signs = [b for b in range(128) if b not in blank and not chr(b).isalnum()]
    cuts[signs, ord("'")] = False
    return cuts.ravel()


class _Memo(dict):
    """Fragment to its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, fragment: bytes) -> bytes:
        ids = array("I", self.encode(fragment.decode("utf-8"))).tobytes()
        if len(fragment) <= MEMO_BYTES:
            if len(self) >= MEMO_FRAGMENTS:
                self.clear()
            self[fragment] = ids
        return ids


def _read_ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}, {}


def _read_tokenizer(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """The ranks and the special tokens of a byte-level BPE tokenizer file."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, letters = spec["model"], _byte_letters()
    pre = spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space"):
        raise ValueError("a byte-level BPE tokenizer without prefix space is expected")
    if spec.get("normalizer") or not pre.get("use_regex", True):
        raise ValueError("normalizers and pattern-free pre-tokenizers are not supported")
    if any(t[flag] for t in spec["added_tokens"] for flag in ("lstrip", "rstrip", "single_word", "normalized")):
        raise ValueError("special tokens that depend on their surroundings are not supported")
    vocab, special = model["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    merged = [vocab[a + b] for a, b in pairs]
    if any(x >= y for x, y in zip(merged, merged[1:])):
        raise ValueError("the ids must follow the merge order")
    return {bytes(letters[c] for c in s): i for s, i in vocab.items() if s not in special}, special


class BoundaryBPE:
    """A byte-level BPE tokenizer, encoded by forced-boundary splitting.

    ``path`` is a tokenizer file (.json; a plain byte-level BPE whose ids follow the
    merge order, so that rank and id agree; anything else is refused) or a list of
    ranks (.tiktoken).
    """

    def __init__(self, path: str):
        import tiktoken

        self.ranks, special = _read_ranks(path) if path.endswith(".tiktoken") else _read_tokenizer(path)
        self.special = special
        self.cuts = certain_cuts(list(self.ranks))
        encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self.memo = _Memo(encoding.encode_ordinary)
        longest_first = sorted(special, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if special else None
        size = 1 + max([*self.ranks.values(), *special.values()])
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in self.ranks.items():
            self.token_bytes[i] = token
        for token, i in special.items():
            self.token_bytes[i] = token.encode("utf-8")

    def fragments(self, data: bytes) -> list[bytes]:
        """``data`` cut at every certain boundary; joined, they give it back."""
        if len(data) < 2:
            return [data] if data else []
        a = np.frombuffer(data, np.uint8)
        cut = self.cuts[(a[:-1].astype(np.uint16) << 8) | a[1:]]
        shift = np.cumsum(cut)
        out = np.full(len(a) + int(shift[-1]), _SEPARATOR[0], np.uint8)
        out[0] = a[0]
        out[np.arange(1, len(a)) + shift] = a[1:]
        return out.tobytes().split(_SEPARATOR)

    def id_bytes(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers."""
        if not self.marks or not any(mark in text for mark in self.special):
            return b"".join(map(self.memo.__getitem__, self.fragments(text.encode("utf-8"))))
        return b"".join(
            array("I", [self.special[part]]).tobytes() if i % 2
            else b"".join(map(self.memo.__getitem__, self.fragments(part.encode("utf-8"))))
            for i, part in enumerate(self.marks.split(text))
        )

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.id_bytes(text), "<u4")

    def decode(self, ids) -> str:
        """The text of ``ids``, special ones included; broken UTF-8 becomes U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def load(path: str) -> BoundaryBPE:
    """One tokenizer per worker and file, with its memo."""
    return BoundaryBPE(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def id_lists(buffers: list[bytes]) -> pa.Array:
    """Id buffers as an Arrow array of integer lists, without Python integers."""
    ends = np.cumsum([0, *(len(b) // 4 for b in buffers)])
    values = pa.array(np.frombuffer(b"".join(buffers), "<i4"))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every text under the tokenizer file ``path``.

    A narrow map, no shuffle.  Null and empty texts give an empty list.
    """

    def encode(batches):
        bpe = load(path)
        for part in slices(batches):
            found = [bpe.id_bytes(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), id_lists(found)], ["doc_id", "ids"])

    source = ids_and_texts(docs)
    return source.mapInArrow(encode, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) of encoded documents; null ids give an empty text."""

    def decode(batches):
        bpe = load(path)
        for part in slices(batches):
            lists = part.column(1)
            texts = [bpe.decode(x.values.to_numpy() if x.is_valid and len(x) else ()) for x in lists]
            yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    source = encoded.select("doc_id", "ids")
    return source.mapInArrow(
        decode, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>, text string"
    )
