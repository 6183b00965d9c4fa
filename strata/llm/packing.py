"""Sequence packing by minimum bin slack.

1. Every document becomes its token ids and an end id, cut into whole windows of the
   capacity and one shorter rest (a narrow map; the pieces go to a scratch table).
2. The pieces are counted by length: at most ``capacity`` rows, whatever the input.
   The driver fills one window at a time from that multiset: the longest piece left
   is set, and a bitset subset-sum dynamic programme over the other lengths finds
   the fill closest to the capacity; the counts are backtracked.  A filling is used
   as often as its lengths last, so each filling uses up a length and there are no
   more than ``capacity`` of them: the driver's work doesn't grow with the corpus.
3. Every piece gets its rank among those of its length (ranks within hashed blocks
   plus the block's base, so no length lands in one task) and by it its sequence
   and offset.

Null and empty texts are the end id alone.  Repeated rows are packed each.  Ties
among equal lengths go by (block, doc_id, start).  An empty table gives no piece.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import bpe
from strata.llm.common import blocks, ids_and_texts, scratch

CAPACITY = 2048
END_ID = 1
ROWS_PER_BLOCK = 4096


@dataclass(frozen=True)
class Filling:
    """A multiset of piece lengths for one window, used for ``times`` windows."""

    uses: dict[int, int]
    times: int


def fill_window(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The window with the longest piece in ``counts`` and the least slack.

    Bit s of ``reach`` says that some pieces sum to s.  Lengths join in falling
    order, copies by doubling; it ends as soon as the window is full.
    """
    longest = max(counts)
    room = capacity - longest
    left = counts | {longest: counts[longest] - 1}
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((n for n in left if n <= room and left[n]), reverse=True):
        most = min(left[length], room // length)
        steps.append((length, most, reach))
        copies, rest = 1, most
        while rest:
            take = min(copies, rest)
            reach |= (reach << (length * take)) & mask
            rest -= take
            copies *= 2
        if reach >> room:
            break
    uses, total = {longest: 1}, reach.bit_length() - 1
    for length, most, before in reversed(steps):
        copies = next(c for c in range(most + 1) if c * length <= total and before >> (total - c * length) & 1)
        if copies:
            uses[length] = uses.get(length, 0) + copies
            total -= copies * length
    return uses


def fillings(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Fillings that use up ``counts`` (pieces by length), each as often as it can be."""
    left = {n: c for n, c in counts.items() if c}
    found = []
    while left:
        uses = fill_window(left, capacity)
        times = min(left[n] // c for n, c in uses.items())
        found.append(Filling(uses, times))
        left = {n: c for n, c in ((n, c - times * uses.get(n, 0)) for n, c in left.items()) if c}
    return found


def places(found: list[Filling]) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """By length: (first rank, copies a window, first sequence, offset of the first
    copy, tokens in the window), in the order of ranks."""
    out: dict[int, list[tuple[int, int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for f in found:
        offset, tokens = 0, sum(n * c for n, c in f.uses.items())
        for length in sorted(f.uses, reverse=True):
            copies = f.uses[length]
            out.setdefault(length, []).append((used.get(length, 0), copies, sequence, offset, tokens))
            used[length] = used.get(length, 0) + copies * f.times
            offset += copies * length
        sequence += f.times
    return out


def cut_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): the pieces of every document,
    whole windows first.  A narrow map."""

    def cut(batches):
        tokenizer, end = bpe.load(path), np.array([end_id], "<u4").tobytes()
        for part in bpe.slices(batches):
            rows, starts, lengths, sums, totals = [], [], [], [], []
            for row, text in enumerate(part.column(1).to_pylist()):
                ids = tokenizer.id_bytes(text) + end
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    rows.append(row)
                    starts.append(start)
                    lengths.append(len(piece) // 4)
                    sums.append(zlib.crc32(piece))
                    totals.append(n)
            columns = [part.column(0).take(pa.array(rows, pa.int64()))]
            columns += [pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    source = ids_and_texts(docs)
    key = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(cut, f"doc_id {key}, start long, length long, ids_crc32 long, doc_tokens long")


def ranked(pieces: DataFrame, n_blocks: int) -> DataFrame:
    """``pieces`` with ``rank``, their number (from 0) among the pieces of their length."""
    held = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "start"), F.lit(n_blocks)))
    sizes = held.groupBy("length", "block").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "block").orderBy("doc_id", "start")
    numbered = held.withColumn("number", F.row_number().over(within) - 1)
    return numbered.join(bases, ["length", "block"]).withColumn("rank", F.col("base") + F.col("number"))


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """All documents packed into sequences of at most ``capacity`` tokens.

    Returns the pieces of ``cut_documents`` with sequence_id, offset and
    sequence_tokens (the tokens that the sequence holds).  ``sequences`` turns them
    into the padded token lists.
    """
    pieces = scratch(cut_documents(docs, path, capacity, end_id), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # <= capacity rows
    plan = places(fillings(counts, capacity))

    def place(batches):
        firsts = {n: [p[0] for p in found] for n, found in plan.items()}
        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            out = []
            for length, rank in zip(columns["length"].to_pylist(), columns["rank"].to_pylist()):
                first, copies, sequence, offset, tokens = plan[length][bisect_right(firsts[length], rank) - 1]
                window, copy = divmod(rank - first, copies)
                out.append((sequence + window, offset + copy * length, tokens))
            added = [pa.array(x, pa.int64()) for x in zip(*out)] if out else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays(
                [columns[c] for c in kept] + added, [*kept, "sequence_id", "offset", "sequence_tokens"]
            )

    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    numbered = ranked(pieces, blocks(sum(counts.values()), ROWS_PER_BLOCK)).select(*kept, "rank")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.select(*kept).schema)
    return numbered.mapInArrow(place, f"{fields}, sequence_id long, offset long, sequence_tokens long")


def sequences(docs: DataFrame, packed: DataFrame, path: str, end_id: int = END_ID, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids): the token lists of ``packed``, padded to the capacity
    unless their length is a power of two.  A sequence is a bounded group; doc_id
    must be unique in ``docs``."""
    encoded = bpe.encode_documents(docs, path)
    pieces = packed.join(encoded, "doc_id").select(
        "sequence_id",
        "offset",
        F.slice(F.concat("ids", F.array(F.lit(end_id))), (F.col("start") + 1).cast("int"), F.col("length").cast("int")).alias("ids"),
    )
    held = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("pieces"))
    ids = held.select("sequence_id", F.flatten(F.col("pieces.ids")).alias("ids"))
    size = F.size("ids")
    whole = size.bitwiseAND(size - 1) == 0
    padding = F.array_repeat(F.lit(pad_id), F.when(whole, 0).otherwise(F.lit(CAPACITY) - size))
    return ids.select("sequence_id", F.concat("ids", padding).alias("ids"))
