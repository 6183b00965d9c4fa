"""Words of many texts at once, counted in arrays.

``tokenize`` gives a row's words as a Spark array; exploded, every token is a row.  Here a
task splits the texts of a batch as one run of bytes, and leaves one row per
distinct word (``batch_word_counts``) or per document (``packed_counts``).

* ASCII letters are single bytes in UTF-8, and no byte of another character is one: words
  are the maximal runs of letter bytes inside a text, as ``tokenize`` has them;
* a task works on SLICE bytes of text at a time, or on one longer text;
* equal ids from different rows are merged after a shuffle by id, in their order: a task
  holds the sums of one document (at most K entries) and ENTRIES more, or one row's;
* an id (null is one) with many rows, seen as a share of a slice, is added up by its task
  before the shuffle (HELD ids at most): K entries leave the task, however many its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE = 8 << 20  # bytes of text that a task splits at once
ENTRIES = 1 << 20  # entries (document, position, count) that a task merges at once
HELD = 64  # ids whose counts a task holds to its end
SHARE = 32  # a slice holds an id from one in so many of its rows

# A byte's lower-case letter, or 0.
LETTER = np.zeros(256, np.uint8)
LETTER[ord("a") : ord("z") + 1] = LETTER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in their order, and the row of each.  Null: none."""
    texts = pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), "")])
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    low = LETTER[raw]
    letter = low != 0
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    filled = bounds[:-1] < bounds[1:]  # a word ends with its text
    begin, end = bounds[:-1][filled], bounds[1:][filled] - 1
    first[begin], last[end] = letter[begin], letter[end]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    cuts = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=cuts[1:])
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(low[letter])])
    return words, np.searchsorted(bounds, starts, "right") - 1


def _cut(batch: pa.RecordBatch, sizes: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
    pieces = np.cumsum(sizes, dtype=np.int64) // size
    cuts = [0, *(np.flatnonzero(np.diff(pieces)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of some SLICE bytes of their last column (texts)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0)
        yield from _cut(batch, sizes.to_numpy(zero_copy_only=False), SLICE)


def batch_word_counts(docs: DataFrame) -> DataFrame:
    """(word, count) of (doc_id, text) rows: a task counts slice by slice, Spark adds up."""

    def run(batches):
        for batch in slices(batches):
            found = pc.value_counts(split_words(batch.column(0))[0])
            yield pa.RecordBatch.from_arrays([found.field(0).cast(pa.string()), found.field(1)], ["word", "n"])

    counted = docs.select("text").mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("count"))


def _codes(ids: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct ids (null is one) in order of their first row, and each row's number among them."""
    coded = ids.dictionary_encode(null_encoding="encode")
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def packed_counts(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """(doc_id, pos[], n[]) of (doc_id, text) rows against a vocabulary (≤ K rows, sent to the
    tasks); rows without a vocabulary word drop.  Equal ids of a slice are merged, and
    those of a task where they are many."""
    table = vocab.select("word", "pos").toArrow()
    known = table.column("word").cast(pa.large_string()).combine_chunks()
    pos = table.column("pos").to_numpy().astype(np.int64)
    width = int(pos.max()) + 1 if len(pos) else 1

    def run(batches):
        held, of = {}, None
        for batch in slices(batches):
            of = batch.schema.field(0).type
            words, row = split_words(batch.column(1))
            at = pc.fill_null(pc.index_in(words, known), -1).to_numpy(zero_copy_only=False)
            ids, code = _codes(batch.column(0))
            found = at >= 0
            entry, n = np.unique(code[row[found]] * width + pos[at[found]], return_counts=True)
            rows = np.bincount(code)
            for c in np.flatnonzero((rows > 1) & (rows * SHARE >= len(code))).tolist():
                name = ids[c].as_py()
                if name in held or len(held) < HELD:
                    a, b = np.searchsorted(entry, (c * width, (c + 1) * width))
                    held.setdefault(name, np.zeros(width, np.int64))[entry[a:b] - c * width] += n[a:b]
                    entry, n = np.delete(entry, slice(a, b)), np.delete(n, slice(a, b))
            sizes = np.bincount(entry // width, minlength=len(ids))
            lists = [_lists((entry % width).astype(np.int32), sizes), _lists(n, sizes)]
            packed = pa.RecordBatch.from_arrays([ids, *lists], ["doc_id", "pos", "n"])
            yield packed.filter(pa.array(sizes > 0))
        for name, counts in held.items():
            there = np.flatnonzero(counts)
            lists = [_lists(x, np.array([len(there)])) for x in (there.astype(np.int32), counts[there])]
            if len(there):
                yield pa.RecordBatch.from_arrays([pa.array([name], of), *lists], ["doc_id", "pos", "n"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, pos array<int>, n array<bigint>")


def _sums(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Rows (doc_id, pos[], n[]) with equal ids merged: ids, entries of each, pos, n."""
    ids, code = _codes(batch.column(0))
    sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    pos, n = (batch.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2))
    if len(ids) < len(code):
        width = int(pos.max()) + 1
        entry, at = np.unique(np.repeat(code, sizes) * width + pos, return_inverse=True)
        pos, n = entry % width, np.bincount(at, n).astype(np.int64)
        sizes = np.bincount(entry // width, minlength=len(ids))
    return ids, sizes, pos, n


def packed_frequencies(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """(doc_id, pos[], tf[]): ``term_frequency`` with one row per document, pos rising.
    One shuffle, of packed rows by doc_id; equal ids stand together after it."""
    dealt = packed_counts(docs, vocab).repartition("doc_id").sortWithinPartitions("doc_id")

    def frequencies(ids, sizes, pos, n):
        total = np.bincount(np.repeat(np.arange(len(ids)), sizes), n, len(ids))
        lists = [_lists(pos.astype(np.int32), sizes), _lists(n / np.repeat(total, sizes), sizes)]
        return pa.RecordBatch.from_arrays([ids, *lists], ["doc_id", "pos", "tf"])

    def run(batches):
        held = None  # the last document so far: the next batch may go on with it
        for batch in (piece for b in batches for piece in _cut(b, b.column(1).value_lengths().to_numpy(zero_copy_only=False), ENTRIES)):
            counts = [c.cast(pa.list_(pa.int64())) for c in batch.columns[1:]]
            batch = pa.RecordBatch.from_arrays([batch.column(0), *counts], ["doc_id", "pos", "n"])
            if held is not None:
                batch = pa.concat_batches([held, batch])
            ids, sizes, pos, n = _sums(batch)
            done, cut = len(ids) - 1, int(sizes[:-1].sum())
            if done:
                yield frequencies(ids.slice(0, done), sizes[:done], pos[:cut], n[:cut])
            last = [ids.slice(done), _lists(pos[cut:], sizes[done:]), _lists(n[cut:], sizes[done:])]
            held = pa.RecordBatch.from_arrays(last, ["doc_id", "pos", "n"])
        if held is not None:
            yield frequencies(*_sums(held))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return dealt.mapInArrow(run, f"doc_id {kind}, pos array<int>, tf array<double>")


def unpacked_frequencies(packed: DataFrame) -> DataFrame:
    """(doc_id, pos[], tf[]) → (doc_id, pos, tf).  Narrow, dealt as before."""
    rows = packed.select("doc_id", F.inline(F.arrays_zip("pos", "tf")))
    return rows.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "tf")
