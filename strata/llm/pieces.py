"""SentencePiece BPE encoding by vectorised merge rounds, and decoding.

The texts of an Arrow batch are split into words at the places that no piece of the
vocabulary crosses, and the different words are encoded together as flat numpy arrays:
one symbol per character, one rank per adjacent pair.  A round finds every word's least
rank (a segmented minimum), merges all pairs of that rank at once, leftmost first where
they overlap, and compacts the arrays; words without a pair leave them.

The library merges one pair at a time, best rank first, leftmost among equals.  A round
does the same to a word as long as no pair that its merges make, in between or at the
end, has a rank as good as the round's.  Words where one does (runs of blanks, whose
pieces share one score) are finished pair by pair from a queue, as are words longer than
LONG symbols, which would take about as many rounds as symbols.  Both ways are exact.

Words recur, so each worker keeps a bounded memo of them.  Texts: null and empty ones
have no ids.  Characters in no piece become their UTF-8 bytes' pieces (or the unknown
piece, where the vocabulary has none).  Repeated rows are encoded each; an empty table gives no row.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.bpe import id_lists, slices
from strata.llm.common import ids_and_texts

SPACE = "▁"  # fixed value: the mark that stands for a blank
UNKNOWN = " ⁇ "  # fixed value: what decoding writes for the unknown piece
NORMAL, UNK, CONTROL, BYTE = 1, 2, 3, 6  # fixed values: piece types of a model file
MEMO_WORDS = 300_000
MEMO_CHARS = 32  # longer words are encoded each time
LONG = 2_048
CHARS = 1 << 20  # about as many characters are merged together
NONE = np.iinfo(np.int32).max  # the rank of a pair that makes no piece


def _per_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("strata-per-byte", _per_byte)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The (number, value) fields of a serialised message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, data[at : at + size]
        at += size


def read_model(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, type) by id.  Only plain BPE models are taken: no normalisation,
    a blank put first, extra blanks kept, no user-defined or unused pieces."""
    with open(path, "rb") as file:
        fields = list(_fields(file.read()))
    entries = [dict(_fields(value)) for number, value in fields if number == 1]
    pieces = [(e[1].decode("utf-8"), struct.unpack("<f", e.get(2, b"\0\0\0\0"))[0], e.get(3, NORMAL)) for e in entries]
    trainer, normalizer = (dict(_fields(b"".join(v for n, v in fields if n == k))) for k in (2, 3))
    if trainer.get(3, 1) != 2 or trainer.get(24, 0):
        raise ValueError("a BPE model with blanks before the words is expected")
    if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(3, 1) or not normalizer.get(5, 1):
        raise ValueError("normalisation and the removal of blanks are not supported")
    if {kind for _, _, kind in pieces} - {NORMAL, UNK, CONTROL, BYTE} or trainer.get(44, UNKNOWN.encode()) != UNKNOWN.encode():
        raise ValueError("user-defined and unused pieces are not supported")
    return pieces


class PieceBPE:
    """A SentencePiece BPE model.  Symbols are numbered: first the normal pieces by
    falling score, then characters that stand only inside pieces."""

    def __init__(self, path: str):
        pieces = read_model(path)
        normal = sorted((-score, i, piece) for i, (piece, score, kind) in enumerate(pieces) if kind == NORMAL)
        self.strings = [piece for _, _, piece in normal]
        number = {piece: n for n, piece in enumerate(self.strings)}
        for c in sorted({c for piece in self.strings for c in piece} - number.keys()):
            number[c] = len(self.strings)
            self.strings.append(c)
        self.size = len(self.strings)
        # Ranks: equal scores share one.
        scores = np.array([score for score, _, _ in normal])
        self.rank_of = np.unique(scores, return_inverse=True)[1].astype(np.int32)

        unknown = next(i for i, (_, _, kind) in enumerate(pieces) if kind == UNK)
        bytes_ids = {int(piece[1:-1], 16): i for i, (piece, _, kind) in enumerate(pieces) if kind == BYTE}
        self.spelled = lambda c: [bytes_ids[b] for b in c.encode("utf-8")] if len(bytes_ids) == 256 else [unknown]
        self.ids = [i for _, i, _ in normal]
        self.id_of = np.array(self.ids + [-1] * (self.size - len(self.ids)), np.int32)

        made = {}
        for piece in self.strings[: len(normal)]:
            for k in range(1, len(piece)):
                a, b = number.get(piece[:k]), number.get(piece[k:])
                if a is not None and b is not None:
                    made[a * self.size + b] = number[piece]
        self.pairs = made
        self._fill(made)

        self.symbol_of = np.full(0x110000, -1, np.int32)
        for c in number:
            if len(c) == 1:
                self.symbol_of[ord(c)] = number[c]
        # No piece has a blank after another character, or words end nowhere but at blanks.
        self.crosses = any(SPACE in piece.lstrip(SPACE) for piece in self.strings)
        self.words = re.compile("(?s).+" if self.crosses else f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        self.memo: dict[str, bytes] = {}

        surface = {CONTROL: "", UNK: UNKNOWN}
        self.surface = [
            bytes([int(piece[1:-1], 16)]) if kind == BYTE else surface.get(kind, piece.replace(SPACE, " ")).encode("utf-8")
            for piece, _, kind in pieces
        ]
        self.kinds = [kind for _, _, kind in pieces]
        self.control = {i for i, kind in enumerate(self.kinds) if kind == CONTROL}

    def _fill(self, made: dict[int, int]) -> None:
        """The pairs as a hash table in arrays; a taken place passes its key on by one."""
        self.bits = max(4, (4 * len(made) + 1).bit_length())
        keys, pieces = np.fromiter(made, np.int64, len(made)), np.fromiter(made.values(), np.int32, len(made))
        self.keys, self.made = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        place = self._place(keys)
        while len(keys):
            first = np.unique(place, return_index=True)[1]
            first = first[self.keys[place[first]] < 0]
            self.keys[place[first]], self.made[place[first]] = keys[first], pieces[first]
            left = np.ones(len(keys), bool)
            left[first] = False
            keys, pieces, place = keys[left], pieces[left], (place[left] + 1) & (len(self.keys) - 1)

    def _place(self, key: np.ndarray) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair of symbols (NONE if it makes no piece), and the piece."""
        key = a.astype(np.int64) * self.size + b
        key[(a < 0) | (b < 0)] = -2
        place = self._place(key)
        held = self.keys[place]
        rank = np.full(len(key), NONE, np.int32)
        piece = np.zeros(len(key), np.int32)
        there = held == key
        found = np.flatnonzero(there)
        piece[found] = self.made[place[found]]
        rank[found] = self.rank_of[piece[found]]
        open_ = np.flatnonzero(~there & (held >= 0))
        while len(open_):
            place[open_] = (place[open_] + 1) & (len(self.keys) - 1)
            held = self.keys[place[open_]]
            found = open_[held == key[open_]]
            piece[found] = self.made[place[found]]
            rank[found] = self.rank_of[piece[found]]
            open_ = open_[(held >= 0) & (held != key[open_])]
        return rank, piece

    def in_order(self, symbols: list[int]) -> list[int]:
        """``symbols`` merged pair by pair: best rank first, leftmost among equals."""
        n, symbols = len(symbols), list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and symbols[i] >= 0 and symbols[j] >= 0:
                piece = self.pairs.get(symbols[i] * self.size + symbols[j])
                if piece is not None:
                    heapq.heappush(queue, (int(self.rank_of[piece]), i, j, symbols[i], symbols[j], piece))

        for i in range(n - 1):
            offer(i, i + 1)
        gone = bytearray(n)
        while queue:
            _, i, j, a, b, piece = heapq.heappop(queue)
            if gone[i] or gone[j] or symbols[i] != a or symbols[j] != b or after[i] != j:
                continue
            symbols[i], gone[j], after[i] = piece, 1, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [s for s, dead in zip(symbols, gone) if not dead]

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All words' symbols after merging, and the word of each, in order."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        word = np.repeat(np.arange(len(words), dtype=np.int32), [len(w) for w in words])
        symbol = self.symbol_of[codes]
        symbol = np.where(symbol < 0, -1 - codes.astype(np.int64), symbol).astype(np.int32)
        done: list[tuple[np.ndarray, np.ndarray]] = []

        def queued(symbol, word):
            """Finish the given words one by one."""
            for part in np.split(np.arange(len(word)), np.flatnonzero(np.diff(word)) + 1):
                if len(part):
                    out = np.array(self.in_order(symbol[part].tolist()), np.int32)
                    done.append((out, np.full(len(out), word[part[0]], np.int32)))

        long = np.array([len(w) > LONG for w in words], bool)[word]
        if long.any():
            queued(symbol[long], word[long])
            symbol, word = symbol[~long], word[~long]

        def ranked(symbol, word, at):
            """Ranks and pieces of the pairs that start at ``at``, NONE across words."""
            after = np.minimum(at + 1, len(symbol) - 1)
            rank, piece = self.look_up(symbol[at], symbol[after])
            rank[(at + 1 >= len(symbol)) | (word[at] != word[after])] = NONE
            return rank, piece

        rank, piece = ranked(symbol, word, np.arange(len(symbol)))
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[starts, len(symbol)])
            least = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            if (over := least == NONE).any():
                done.append((symbol[over], word[over]))
                left = ~over
                symbol, word, rank, piece, least = symbol[left], word[left], rank[left], piece[left], least[left]
                if not len(symbol):
                    break
            hits = np.flatnonzero(rank == least)
            # Of pairs that overlap, every second one of a run is merged, from the left.
            first = np.r_[True, np.diff(hits) != 1]
            in_run = np.arange(len(hits)) - np.maximum.accumulate(np.where(first, np.arange(len(hits)), 0))
            hits = hits[in_run % 2 == 0]
            stays = np.ones(len(symbol), bool)
            stays[hits + 1] = False
            joined = symbol.copy()
            joined[hits] = piece[hits]
            new_symbol, new_word = joined[stays], word[stays]
            at = hits - np.arange(len(hits))  # where the merged symbols are now
            near = np.zeros(len(new_symbol), bool)
            near[at] = near[at[at > 0] - 1] = True
            touched = np.flatnonzero(near)
            new_rank, new_piece = rank[stays], piece[stays]
            new_rank[touched], new_piece[touched] = ranked(new_symbol, new_word, touched)
            # A pair as good as the round's, with the next symbol as it was or as it is now.
            good = np.zeros(len(new_symbol), bool)
            good[touched] = new_rank[touched] <= least[stays][touched]
            two = np.minimum(hits + 2, len(symbol) - 1)
            between = self.look_up(piece[hits], symbol[two])[0]
            between[(hits + 2 >= len(symbol)) | (word[two] != word[hits])] = NONE
            good[at] |= between <= least[hits]
            if good.any():
                by_one = np.zeros(int(word[-1]) + 1, bool)
                by_one[new_word[good]] = True
                queued(symbol[by_one[word]], word[by_one[word]])
                left = ~by_one[new_word]
                new_symbol, new_word, new_rank, new_piece = new_symbol[left], new_word[left], new_rank[left], new_piece[left]
            symbol, word, rank, piece = new_symbol, new_word, new_rank, new_piece

        symbol, word = (np.concatenate([np.zeros(0, np.int32), *parts]) for parts in ([d[0] for d in done], [d[1] for d in done]))
        order = np.argsort(word, kind="stable")
        return symbol[order], word[order]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Each word's ids as little-endian 32-bit integers."""
        if not words:
            return []
        symbol, word = self.merged(words)
        known = symbol >= 0
        ids = np.where(known, self.id_of[np.maximum(symbol, 0)], -1)
        if (ids < 0).any():  # characters that are no piece: spelled out
            gaps = np.flatnonzero(ids < 0)
            put = [self.spelled(self.strings[s] if s >= 0 else chr(-1 - s)) for s in symbol[gaps].tolist()]
            sizes = np.ones(len(ids), np.int64)
            sizes[gaps] = [len(p) for p in put]
            word, ids, gap = np.repeat(word, sizes), np.repeat(ids, sizes), np.repeat(ids < 0, sizes)
            ids[gap] = [i for p in put for i in p]
        ends = np.searchsorted(word, np.arange(len(words) + 1)) * 4
        data = ids.astype("<i4").tobytes()
        return [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def split(self, text: str) -> list[str]:
        """The words of a text, each without the one blank that begins it."""
        if not text:
            return []
        if self.crosses or "  " in text or SPACE in text or text[0] == " ":
            return [w[1:] for w in self.words((" " + text).replace(" ", SPACE))]
        return text.split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian 32-bit integers."""
        split, memo = list(map(self.split, texts)), self.memo
        different = set().union(*split)
        new = list(different.difference(memo))
        if len(memo) + len(new) > MEMO_WORDS:
            memo.clear()
            new = list(different)
        ends = np.cumsum([len(w) + 1 for w in new], dtype=np.int64)
        cuts = [0, *np.flatnonzero(np.diff(ends // CHARS)) + 1, len(new)]
        for a, b in zip(cuts, cuts[1:]):
            memo.update(zip(new[a:b], self.encode_words([SPACE + w for w in new[a:b]])))
        out = [b"".join(map(memo.__getitem__, words)) for words in split]
        if len(memo) > MEMO_WORDS:
            memo.clear()
        for w in new:
            if len(w) > MEMO_CHARS:
                memo.pop(w, None)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: one blank goes at its start, neighbouring byte pieces are
        joined, and every byte of broken UTF-8 becomes U+FFFD."""
        out = list(map(self.surface.__getitem__, ids))
        first = next((k for k, i in enumerate(ids) if self.kinds[i] != CONTROL), None)
        if first is not None and self.kinds[ids[first]] == NORMAL and out[first].startswith(b" "):
            out[first] = out[first][1:]
        if self.control.isdisjoint(ids):
            return b"".join(out).decode("utf-8", "strata-per-byte")
        ends = [k for k, i in enumerate(ids) if i in self.control]  # bytes aren't joined across these
        return "".join(b"".join(out[a:b]).decode("utf-8", "strata-per-byte") for a, b in zip([0, *ends], [*ends, len(ids)]))


@lru_cache(maxsize=2)
def load(path: str) -> PieceBPE:
    """One model per worker and file, with its memo."""
    return PieceBPE(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every text under the model file ``path``.  A narrow map, no shuffle."""

    def encode(batches):
        model = load(path)
        for part in slices(batches):
            found = model.encode(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), id_lists(found)], ["doc_id", "ids"])

    source = ids_and_texts(docs)
    return source.mapInArrow(encode, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) of encoded documents; null ids give an empty text."""

    def decode(batches):
        model = load(path)
        for part in slices(batches):
            lists = part.column(1)
            texts = [model.decode(x.values.to_pylist() if x.is_valid and len(x) else []) for x in lists]
            yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    source = encoded.select("doc_id", "ids")
    return source.mapInArrow(
        decode, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>, text string"
    )
