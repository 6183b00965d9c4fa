"""Byte spans that repeat across documents, by a run-length compressed index.

A byte goes if a LENGTH-byte string that covers it also starts in a document of
smaller id.  The work is dealt out by content, so that no document meets the corpus:

1. Every run of windows (LENGTH-byte strings) whose smallest GRAM-byte hash is the same
   makes one segment; equal windows always fall into segments of the same hash.  The
   texts are grouped by a hash of their id; a group sends its distinct hashes, and
   learns which of them another document has too.
2. Segments of such hashes go to the bucket of their hash, once per group and content,
   with the smallest document that has them.  A hash whose contents are more bytes than
   its part of a bucket (the ends of a passage that many documents share: the same
   string, beside it other bytes in each) is dealt out again: its windows go, each by
   itself, to the bucket of their own checksum, so equal ones still meet.
3. A bucket indexes its distinct segments (those with another one of their hash): a Burrows-Wheeler transform over all of
   them, kept as runs, and the rows at which a new LENGTH-byte string begins, from the
   suffix order (the suffix samples at both run ends are not needed for it).  The segments are streamed backward through the runs;
   each step's row tells the longest match of the window with the rest as far as
   LENGTH, and by it the smallest document that has the window.
4. Groups get back one bit per window of their segments, cover the marked windows and
   cut the bytes.

A hash, segment or document that many rows share enters a bucket once per group, and
texts are never sent outside their group.  Groups and buckets grow in number with the
bytes, not in size (a document is the least unit of a group).

Texts are UTF-8 bytes; null ones are empty.  Windows never cross documents.  Rows with
the same doc_id are one document for "smaller", a null doc_id is smaller than all.
Texts under LENGTH bytes stay whole.  An empty table gives no row.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import blocks, ids_and_texts

LENGTH = 50
GRAM = 16
SPAN = LENGTH - GRAM + 1  # most windows in a segment
GROUP_BYTES, BUCKET_BYTES = 4_000_000, 2_000_000
HASH_SHARE = 4  # a hash may fill one in so many parts of a bucket
JOINED = 1 << 15  # bytes of texts whose segments are found at once
SEVERAL = 32  # from so many segments of a hash in a group on, its different contents are counted
SEGMENTS = 1 << 14  # so many at once get their bits
_DEALT = 1 << 48  # set in the hash of a window that goes by itself; gram hashes have 48 bits
_LEAST = np.iinfo(np.int64).min
_U = np.uint64


# ------------------------------------------------------------------ segments of a text


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all GRAM-byte strings (GRAM is two words of eight bytes)."""
    words = np.empty(len(data) - 7, np.uint64)
    for i in range(8):
        own = words[i::8]
        own[:] = data[i : i + 8 * len(own)].view("<u8")
    h = words[:-8] * _U(0x9E3779B97F4A7C15)
    h += words[8:]
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(29)
    h *= _U(0x94D049BB133111EB)
    return h >> _U(16)  # 48 bits travel; equal ones only cost a comparison


def segments(data: np.ndarray, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, number of windows) of every segment of a text, in order; or of
    several texts in one, that end at ``ends``: no window crosses these."""
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    least, size = gram_hashes(data), 1
    while size * 2 <= SPAN:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    if size < SPAN:
        least = np.minimum(least[: len(least) - (SPAN - size)], least[SPAN - size :])
    ends = np.array([len(data)]) if ends is None else ends
    begins = np.concatenate([[0], ends[:-1]])
    stops = np.maximum(ends - LENGTH + 1, begins)  # of the windows of each text
    new = np.concatenate([[True], least[1:] != least[:-1]])
    edges = np.concatenate([begins, stops])
    new[edges[edges < len(least)]] = True
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(least)))
    inside = starts < stops[np.searchsorted(ends, starts, "right")]
    starts, sizes = starts[inside], sizes[inside]
    if (sizes > SPAN).any():  # a repeating text; its runs are cut to length
        pieces = -(-sizes // SPAN)
        offset = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        ends = np.repeat(starts + sizes, pieces)
        starts = np.repeat(starts, pieces) + offset * SPAN
        sizes = np.minimum(ends - starts, SPAN)
    return least[starts], starts, sizes


class Group:
    """The documents of a group in the order of their ids."""

    def __init__(self, table: pa.Table):
        ids = table.column("id").to_numpy(zero_copy_only=False)
        self.order = np.argsort(ids, kind="stable")
        texts = table.column("text").to_pylist()
        self.ids = ids[self.order]
        self.texts = [texts[i].encode("utf-8") for i in self.order]
        # Texts in pieces of about JOINED bytes: short ones aren't taken one by one, and
        # what is computed of a piece stays in the processor's cache.
        self.joined = b"".join(self.texts)
        data, sizes = np.frombuffer(self.joined, np.uint8), np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        ends = np.cumsum(sizes)
        cuts = [0, *(np.flatnonzero(np.diff(ends // JOINED)) + 1).tolist(), len(ends)]
        found = []
        for x, y in zip(cuts, cuts[1:]):
            if y > x:
                begin = ends[x] - sizes[x]
                h, at, n = segments(data[begin : ends[y - 1]], ends[x:y] - begin)
                found.append((h, at + begin, n))
        self.hash, self.at, self.windows = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 2)
        self.doc = np.searchsorted(ends, self.at, "right")
        self.start = self.at - (ends - sizes)[self.doc]

    def bytes_of(self, i: np.ndarray) -> list[bytes]:
        joined, at = self.joined, self.at[i]
        return [joined[a:b] for a, b in zip(at.tolist(), (at + self.windows[i] + (LENGTH - 1)).tolist())]

    def counted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct hashes, whether several documents have each, and the binary
        logarithm, rounded up, of how many contents it has at most."""
        order = np.argsort(self.hash)
        h, doc = self.hash[order], self.ids[self.doc[order]]
        starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        several = np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts) if len(h) else np.zeros(0, bool)
        counts = np.diff(np.append(starts, len(h)))
        for i in np.flatnonzero(counts >= SEVERAL).tolist():
            counts[i] = len(set(self.bytes_of(order[starts[i] : starts[i] + counts[i]])))
        return h[starts], several, np.ceil(np.log2(counts)).astype(np.uint8)

    def contents(self, shared: np.ndarray, dealt: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """Segment numbers whose hash is in ``shared`` (sorted), their bytes, and whether
        their windows go by themselves (``dealt`` tells it by hash)."""
        at = np.minimum(np.searchsorted(shared, self.hash), max(len(shared) - 1, 0))
        found = np.flatnonzero(shared[at] == self.hash) if len(shared) else np.zeros(0, np.int64)
        return found, self.bytes_of(found), dealt[at[found]]

    def by_bucket(
        self, found: np.ndarray, contents: list[bytes], dealt: np.ndarray, n_buckets: int
    ) -> Iterator[tuple[int, list[bytes], list[int], list[int]]]:
        """(bucket, contents, smallest document and hash of each) of what ``contents``
        gives, in one order for all passes.  A dealt content gives its windows."""
        docs, hashes = self.doc[found], self.hash[found]
        plain = np.flatnonzero(~dealt)
        # The last of equal keys stays, so backward the first of each content does.
        first = dict(zip([contents[i] for i in plain[::-1].tolist()], plain[::-1].tolist()))
        listed = sorted(first)
        at = np.fromiter(map(first.__getitem__, listed), np.int64, len(listed))
        buckets, docs_, own = (hashes[at] % _U(n_buckets)).astype(np.int64), docs[at], hashes[at].astype(np.int64)
        split: dict[bytes, int] = {}
        for i in np.flatnonzero(dealt).tolist():
            split.setdefault(contents[i], int(docs[i]))
        if split:
            windows: dict[bytes, int] = {}
            for content, doc in split.items():  # in the order of their documents
                for window in windows_of(content):
                    windows.setdefault(window, doc)
            keys = [(crc32(w) % n_buckets, w) for w in windows]
            held = set(zip(buckets.tolist(), listed))
            keys = [k for k in keys if k not in held]
            listed += [w for _, w in keys]
            order = sorted(range(len(listed)), key=listed.__getitem__)
            listed = [listed[i] for i in order]
            buckets = np.append(buckets, np.array([b for b, _ in keys], np.int64))[order]
            docs_ = np.append(docs_, np.array([windows[w] for _, w in keys], np.int64))[order]
            own = np.append(own, np.full(len(keys), _DEALT, np.int64))[order]
        order = np.argsort(buckets.astype(np.min_scalar_type(n_buckets)), kind="stable")  # short numbers sort faster
        buckets, ids, own = buckets[order], self.ids[docs_[order]], own[order]
        cuts = [*np.flatnonzero(np.diff(buckets, prepend=-1)).tolist(), len(order)]
        for x, y in zip(cuts[:-1], cuts[1:]):
            yield int(buckets[x]), [listed[i] for i in order[x:y].tolist()], ids[x:y].tolist(), own[x:y].tolist()


def windows_of(content: bytes) -> list[bytes]:
    return [content[i : i + LENGTH] for i in range(len(content) - LENGTH + 1)]


# ---------------------------------------------------------------------- the index


class RunIndex:
    """A run-length compressed Burrows-Wheeler transform of several strings.

    Every string ends in a separator of its own, above all bytes of UTF-8 and in the
    order of the strings.  Kept are the runs, the suffixes at their two ends, and the
    rows that begin a new string of ``length`` bytes; the suffix array is dropped.
    """

    SEPARATOR = 255

    def __init__(self, strings: list[bytes], length: int = LENGTH):
        joined = np.frombuffer(b"\xff".join(strings) + b"\xff" if strings else b"", np.uint8)
        self.size, self.length = len(joined), length
        self.ends = np.flatnonzero(joined == self.SEPARATOR)
        self.begins = np.concatenate([[0], self.ends[:-1] + 1]) if len(self.ends) else self.ends
        left = np.repeat(self.ends, self.ends - self.begins + 1) - np.arange(self.size)  # bytes to the separator
        order, rank_by = self._sorted(joined, left)
        before = joined[order - 1]
        change = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]])) if self.size else np.zeros(0, np.int64)
        self.run_start, self.run_byte = change, before[change]
        run_length = np.diff(np.append(change, self.size))
        self.first_sample, self.last_sample = order[change], order[change + run_length - 1]
        self.run_of = np.repeat(np.arange(len(change), dtype=np.int32), run_length)  # the run of each row
        counts = np.bincount(joined, minlength=256)
        self.smaller = np.cumsum(counts) - counts
        self.run_rank = np.zeros(len(change), np.int64)
        by_byte = np.argsort(self.run_byte, kind="stable")
        total = np.cumsum(run_length[by_byte]) - run_length[by_byte]
        self.run_rank[by_byte] = total - self.smaller[self.run_byte[by_byte]]
        whole = left[order] >= length
        a, b = order[:-1], order[1:]
        same = whole[:-1] & whole[1:] if self.size else np.zeros(0, bool)
        for size, shift in self._cover(length, rank_by):
            rank = rank_by[size]
            same &= rank[np.minimum(a + shift, self.size - 1)] == rank[np.minimum(b + shift, self.size - 1)]
        self.new_string = np.concatenate([[True], ~same]) if self.size else same

    @staticmethod
    def _cover(length: int, rank_by: dict[int, np.ndarray]):
        """Prefix sizes and shifts that together compare ``length`` bytes."""
        size = max(s for s in rank_by if s <= length)
        return [(size, shift) for shift in [*range(0, length - size, size), length - size]]

    def _sorted(self, joined: np.ndarray, left: np.ndarray):
        """The suffix array by prefix doubling from eight bytes on, and the ranks by
        prefix size.  Each round sorts only what is still tied."""
        n = self.size
        padded = np.concatenate([joined, np.full(8, self.SEPARATOR, np.uint8)])
        key = np.zeros(n, np.uint64)
        for i in range(8):  # what follows a separator doesn't count
            byte = padded[i : i + n]
            key = (key << _U(8)) | (byte if i == 0 else np.where(left < i, np.uint8(self.SEPARATOR), byte))
        order = np.argsort(key)
        ordered, done = key[order], left[order] < 8
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if n else done
        # Equal to the separator: in the order of the strings.
        ended = np.flatnonzero(done & ~(new & np.append(new[1:], True))) if n else order
        order[ended] = np.sort(np.cumsum(new)[ended] * n + order[ended]) % max(n, 1)
        new |= done
        size, rank = 8, np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank_by = {8: rank.copy()}
        while True:
            tied = np.flatnonzero(~new | np.append(~new[1:], False))
            if not len(tied):
                return order, rank_by
            at = order[tied]
            key = rank[at] * np.int64(n + 1) + rank[at + size]
            by_key = np.argsort(key)
            at, key = at[by_key], key[by_key]
            order[tied] = at
            new[tied] = np.concatenate([[True], key[1:] != key[:-1]])
            rank[at] = np.maximum.accumulate(np.where(new[tied], tied, 0))
            size *= 2
            if size <= self.length:
                rank_by = {size: rank.copy()}

    def step_back(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes before the suffixes of ``rows``, and the rows that start there."""
        run = self.run_of[rows]
        byte = self.run_byte[run]
        return byte, self.smaller[byte] + self.run_rank[run] + rows - self.run_start[run]

    def locate(self, row: int) -> int:
        """The text position of a row: back to a sampled run end, and on from there."""
        steps = 0
        while True:
            run = int(np.searchsorted(self.run_start, row, "right")) - 1
            last = (self.run_start[run + 1] if run + 1 < len(self.run_start) else self.size) - 1
            if row == self.run_start[run]:
                return int(self.first_sample[run]) + steps
            if row == last:
                return int(self.last_sample[run]) + steps
            byte, rows = self.step_back(np.array([row]))
            row, steps = int(rows[0]), steps + 1

    def stream(self) -> np.ndarray:
        """For every position the number of the ``length``-byte string that starts
        there (-1 if the separator is nearer): all strings stream backward at once."""
        number = np.cumsum(self.new_string) - 1
        out = np.full(self.size, -1, np.int64)
        rows = self.size - len(self.ends) + np.arange(len(self.ends))
        at = self.ends.copy()
        alive = np.flatnonzero(at > self.begins)
        while len(alive):
            _, rows[alive] = self.step_back(rows[alive])
            at[alive] -= 1
            long = alive[self.ends[alive] - at[alive] >= self.length]
            out[at[long]] = number[rows[long]]
            alive = alive[at[alive] > self.begins[alive]]
        return out


def smallest_documents(contents: list[bytes], documents: np.ndarray) -> list[np.ndarray]:
    """For every window of every content the smallest document of a content that has
    it; ``documents`` holds each content's smallest."""
    index = RunIndex(contents)
    number = index.stream()
    valid = np.flatnonzero(number >= 0)
    owner = np.repeat(documents, index.ends - index.begins + 1)
    least = np.full(int(number.max()) + 1 if len(valid) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, number[valid], owner[valid])
    found = np.full(len(number), _LEAST)
    found[valid] = least[number[valid]]
    return [found[a : max(a, b - LENGTH + 1)] for a, b in zip(index.begins, index.ends)]


# ----------------------------------------------------------------------- the passes

_ROW = pa.schema([("group", pa.int64()), ("bucket", pa.int64()), ("kind", pa.int32()), ("data", pa.binary()), ("more", pa.binary())])
_TYPE = "group long, bucket long, kind int, data binary, more binary"
_SHARED, _BITS = 0, 1


def _uncollected(compute: Callable[..., pa.Table], *tables: pa.Table) -> pa.Table:
    """``compute`` without the search for cycles: it makes many objects, and no cycles."""
    gc.disable()
    try:
        return compute(*tables)
    finally:
        gc.enable()


def _rows(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows) if rows else [[]] * 5, _ROW)], schema=_ROW)


def _hashes(data: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(d, np.dtype([("lo", "<u4"), ("hi", "<u2")])) for d in data]


def _unpack(packed: np.ndarray) -> np.ndarray:
    return packed["lo"].astype(np.uint64) | (packed["hi"].astype(np.uint64) << _U(32))


def _pack(h: np.ndarray) -> bytes:
    out = np.empty(len(h), np.dtype([("lo", "<u4"), ("hi", "<u2")]))
    out["lo"], out["hi"] = h & _U(0xFFFFFFFF), h >> _U(32)
    return out.tobytes()


def _shared_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The hashes that other documents have too, in order, and whether each is dealt out."""
    kinds, data, more = (table.column(c).to_pylist() for c in ("kind", "data", "more"))
    own = [i for i, k in enumerate(kinds) if k == _SHARED]
    if not own:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    found = [_unpack(x) for x in _hashes([data[i] for i in own])]
    dealt = np.concatenate([np.unpackbits(np.frombuffer(more[i], np.uint8), count=len(x)) for i, x in zip(own, found)])
    order = np.argsort(h := np.concatenate(found))
    return h[order], dealt[order].astype(bool)


def grouped_texts(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, id, text, group) and the number of buckets."""
    source = ids_and_texts(docs)
    size = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_groups, n_buckets = blocks(size, GROUP_BYTES), blocks(size, BUCKET_BYTES)
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST))
    return source.select("doc_id", id_.alias("id"), "text", F.pmod(F.xxhash64("doc_id"), F.lit(n_groups)).cast("long").alias("group")), n_buckets


def bucketed(grouped: DataFrame, n_buckets: int) -> tuple[DataFrame, DataFrame]:
    """What every group learns of its hashes, and what it sends to the buckets."""
    most = BUCKET_BYTES // HASH_SHARE // (SPAN + LENGTH - 1)  # contents of a hash

    def send_hashes(table: pa.Table) -> pa.Table:
        h, several, contents = Group(table).counted()
        bucket, more = (h % _U(n_buckets)).astype(np.int64), contents | (several.astype(np.uint8) << 7)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        number = table.column("group")[0].as_py()
        return _rows(
            [
                (number, b, _SHARED, _pack(h[order[x:y]]), more[order[x:y]].tobytes())
                for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:]))
                if y > x
            ]
        )

    def find_shared(table: pa.Table) -> pa.Table:
        packed = _hashes(table.column("data").to_pylist())
        parts = [_unpack(x) for x in packed]
        h, more = np.concatenate(parts), np.frombuffer(b"".join(table.column("more").to_pylist()), np.uint8)
        values, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
        shared = counts > 1
        shared[inverse[more >> 7 == 1]] = True
        dealt = np.bincount(inverse, np.exp2(more & 127), len(values)) > most
        mask, dealt, out, at = shared[inverse], dealt[inverse], [], 0
        for group, bucket, part in zip(table.column("group").to_pylist(), table.column("bucket").to_pylist(), parts):
            mine = slice(at, at + len(part))
            at += len(part)
            if mask[mine].any():
                out.append((group, bucket, _SHARED, _pack(part[mask[mine]]), np.packbits(dealt[mine][mask[mine]]).tobytes()))
        return _rows(out)

    def send_segments(table: pa.Table, shared: pa.Table) -> pa.Table:
        if not table.num_rows or not shared.num_rows:
            return _rows([])
        number, group = table.column("group")[0].as_py(), Group(table)
        found, contents, dealt = group.contents(*_shared_of(shared))
        return _rows(
            [
                (number, bucket, _BITS, b"\xff".join(listed), np.array([ids, hashes], "<i8").tobytes())
                for bucket, listed, ids, hashes in group.by_bucket(found, contents, dealt, n_buckets)
            ]
        )

    texts = grouped.groupBy("group")
    hashes = texts.applyInArrow(lambda table: _uncollected(send_hashes, table), _TYPE)
    shared = hashes.groupBy("bucket").applyInArrow(find_shared, _TYPE)
    return shared, texts.cogroup(shared.groupBy("group")).applyInArrow(
        lambda table, shared: _uncollected(send_segments, table, shared), _TYPE
    )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): the removed byte runs of every text (start, end)
    and the bytes left."""
    grouped, n_buckets = grouped_texts(docs)

    def mark(table: pa.Table) -> pa.Table:
        parts = [d.split(b"\xff") for d in table.column("data").to_pylist()]
        more = [np.frombuffer(m, "<i8").reshape(2, -1) for m in table.column("more").to_pylist()]
        own, hashes = np.concatenate(more, axis=1)
        number: dict[bytes, int] = {}
        at = np.fromiter((number.setdefault(c, len(number)) for part in parts for c in part), np.int64, len(own))
        contents = list(number)
        first = np.full(len(contents), np.iinfo(np.int64).max)
        np.minimum.at(first, at, own)
        dealt, plain, hash_of = np.zeros(len(contents), bool), hashes != _DEALT, np.full(len(contents), _DEALT)
        dealt[at[~plain]] = True  # such a window is nowhere but in its equals
        hash_of[at[plain]] = hashes[plain]
        _, inverse, counts = np.unique(hash_of, return_inverse=True, return_counts=True)
        # A segment that no other one of its hash stands beside shares no window.
        several = np.flatnonzero(~dealt & (counts[inverse] > 1))
        windows = np.fromiter(map(len, contents), np.int64, len(contents)) - LENGTH + 1
        begins = np.cumsum(windows) - windows
        least = np.repeat(first, windows)
        listed = np.array(sorted(several.tolist(), key=contents.__getitem__), np.int64)
        for x, found in zip(begins[listed].tolist(), smallest_documents([contents[i] for i in listed.tolist()], first[listed])):
            least[x : x + len(found)] = found
        n = windows[at]
        ends = np.cumsum(n)
        bits = least[np.repeat(begins[at] - (ends - n), n) + np.arange(n.sum())] < np.repeat(own, n)
        rows = ends[np.cumsum([*map(len, parts)]) - 1].tolist()
        return _rows(
            [
                (group, bucket, _BITS, np.packbits(bits[x:y]).tobytes(), b"")
                for group, bucket, x, y in zip(table.column("group").to_pylist(), table.column("bucket").to_pylist(), [0, *rows], rows)
            ]
        )

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"n": pa.array([], pa.int64())}).select([])
        group = Group(table)
        kinds, buckets, data = (answers.column(c).to_pylist() for c in ("kind", "bucket", "data"))
        bits = {b: d for k, b, d in zip(kinds, buckets, data) if k == _BITS}
        found, contents, dealt = group.contents(*_shared_of(answers))
        marks: dict[bytes, tuple[int, int]] = {}  # the smallest document here, and where the content's bits begin
        single: dict[bytes, tuple[int, int]] = {}
        flat, at = [np.zeros(0, np.uint8)], 0
        for bucket, listed, ids, hashes in group.by_bucket(found, contents, dealt, n_buckets):
            counts = np.fromiter(map(len, listed), np.int64, len(listed)) - LENGTH + 1
            begins = (at + np.cumsum(counts) - counts).tolist()
            flat.append(np.unpackbits(np.frombuffer(bits[bucket], np.uint8), count=int(counts.sum())))
            at += len(flat[-1])
            for content, where, h in zip(listed, zip(ids, begins), hashes):
                (single if h == _DEALT else marks)[content] = where
        marked = np.concatenate(flat).astype(bool)
        ends = np.cumsum([0, *(len(t) + 1 for t in group.texts)])
        whole = np.zeros(ends[-1], bool)
        own_id, to, n = group.ids[group.doc[found]], ends[group.doc[found]] + group.start[found], group.windows[found]
        plain = np.flatnonzero(~dealt)
        for x in range(0, len(plain), SEGMENTS):
            some = plain[x : x + SEGMENTS]
            own, begin = np.array([marks[contents[i]] for i in some.tolist()], np.int64).T
            step = np.arange(n[some].sum()) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
            bit = marked[np.repeat(begin, n[some]) + step] | np.repeat(own_id[some] > own, n[some])
            whole[np.repeat(to[some], n[some]) + step] = bit
        for i in np.flatnonzero(dealt).tolist():
            own, begin = np.array([single[w] for w in windows_of(contents[i])], np.int64).T
            whole[to[i] : to[i] + len(own)] = (own_id[i] > own) | marked[begin]
        windows = [whole[x:y] for x, y in zip(ends[:-1], ends[1:])]
        spans, kept = [], []
        for text, removed in zip(group.texts, windows):
            hits = np.flatnonzero(removed)
            if not len(hits):
                spans.append([])
                kept.append(text)
                continue
            gaps = np.flatnonzero(np.diff(hits) > LENGTH)
            begins, ends = hits[np.append(0, gaps + 1)], hits[np.append(gaps, len(hits) - 1)] + LENGTH
            spans.append([{"start": a, "end": b} for a, b in zip(begins.tolist(), ends.tolist())])
            edges = [0, *(x for pair in zip(begins.tolist(), ends.tolist()) for x in pair), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
        span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        return pa.table(
            {
                "doc_id": table.column("doc_id").take(pa.array(group.order)),
                "n_bytes": pa.array([len(t) for t in group.texts], pa.int64()),
                "spans": pa.array(spans, pa.list_(span)),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    shared, pieces = bucketed(grouped, n_buckets)
    answers = shared.unionByName(pieces.groupBy("bucket").applyInArrow(lambda table: _uncollected(mark, table), _TYPE))
    key = docs.schema["doc_id"].dataType.simpleString()
    return grouped.groupBy("group").cogroup(answers.groupBy("group")).applyInArrow(
        lambda table, answers: _uncollected(cut, table, answers), f"doc_id {key}, n_bytes long, spans array<struct<start: int, end: int>>, kept binary"
    )
