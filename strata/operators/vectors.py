"""Best documents of each query in one narrow pass over packed vectors.

Long-form scoring joins every row of the index with the queries and sums one row per
shared position in Spark's aggregate.  Here a document is one row (pos[], value[]), a task
adds up whole blocks of documents as arrays, and at most k rows per query leave it:

* the queries are a postings list by position, in blocks of bounded size (QUERY_ENTRIES
  entries): each block is one pass, however many queries there are;
* a block of documents has an upper bound for every query, from the largest value of
  each position in it; queries whose k-th best score so far is above their bound skip the
  block, and the k-th best only rises from block to block;
* what remains is multiplied out position by position and summed by (query, document).

A task holds one block's products (ROWS at most, or one document's) and k rows per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUERY_ENTRIES = 1 << 20  # entries (query, position, value) that travel with a task
ROWS = 1 << 20  # products that a task holds at once
DIGITS = 9  # scores are compared as rounded to these


class Packed(NamedTuple):
    """Vectors with one row per document.  With ``weights`` (pos, idf; ≤ K rows) a
    position's value is still to be multiplied by its weight."""

    rows: DataFrame  # (doc_id, pos[], value[]), the last column by any name
    weights: DataFrame | None = None


def pack_vectors(rows: DataFrame) -> DataFrame:
    """Long-form (doc_id, pos, value) → one row per document (doc_id, pos[], value[]).
    No shuffle where the rows are dealt by doc_id; a document has at most K entries."""
    packed = rows.groupBy("doc_id").agg(F.collect_list(F.struct("pos", "value")).alias("entries"))
    return packed.select("doc_id", F.col("entries.pos").alias("pos"), F.col("entries.value").alias("value"))


class Queries:
    """A block of query vectors as postings by position."""

    def __init__(self, table: pa.Table, cosine: bool):
        names = pa.concat_arrays(table.column("query_id").chunks or [pa.array([], table.schema.field("query_id").type)])
        names = names.dictionary_encode(null_encoding="encode")
        ids, row = names.dictionary, names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        pos, value = (table.column(c).to_numpy() for c in ("pos", "value"))
        order = np.argsort(pos, kind="stable")
        self.ids, self.row, self.pos, self.value = ids, row[order], pos[order].astype(np.int64), value[order].astype(np.float64)
        if cosine:
            norm = np.sqrt(np.bincount(self.row, self.value**2, len(ids)))
            self.value = np.divide(self.value, norm[self.row], out=np.zeros_like(self.value), where=norm[self.row] > 0)
        self.positions = int(self.pos[-1]) + 1 if len(self.pos) else 0


class Best:
    """The k best documents of each query so far: score falling, then id, null first."""

    def __init__(self, n: int, k: int):
        self.k, self.rows, self.least = k, [[] for _ in range(n)], np.zeros(n)

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.k:
            keep = scores >= np.partition(scores, -self.k)[-self.k]
            scores, ids = scores[keep], ids[keep]
        rows = self.rows[query] + [(s, i is not None, i) for s, i in zip((-scores).tolist(), ids.tolist())]
        self.rows[query] = sorted(rows)[: self.k]
        if len(self.rows[query]) == self.k:
            self.least[query] = -self.rows[query][-1][0]


def search(batches: Iterator[pa.RecordBatch], queries: Queries, k: int, cosine: bool, zeros: bool = False, weight_of: np.ndarray | None = None) -> tuple[Best, int]:
    """The best documents of a task's batches (doc_id, pos[], value[]), and how many
    products were summed for them.  With ``zeros`` scores of 0 count too, of documents
    that share a position with the query."""
    best, summed, n = Best(len(queries.ids), k), 0, len(queries.ids)
    every = np.bincount(queries.pos, minlength=queries.positions + 1)
    for batch in batches:
        sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
        pos, value = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (1, 2))
        ids = np.array(batch.column(0).to_pylist(), object) if batch.column(0).null_count else batch.column(0).to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(ids)), sizes)
        if weight_of is not None:
            value = value * weight_of[pos]
        if cosine:
            norm = np.sqrt(np.bincount(doc, value**2, len(ids)))[doc]
            value = np.divide(value, norm, out=np.zeros_like(value), where=norm > 0)
        pos = np.minimum(pos, queries.positions)  # positions beyond the queries' match none
        shared = every[pos] > 0
        pos, value, doc = pos[shared], value[shared], doc[shared]
        products = np.cumsum(np.bincount(doc, every[pos], len(ids)))
        cuts = [0, *(np.flatnonzero(np.diff(products // ROWS)) + 1).tolist(), len(ids)]
        for first, last in zip(cuts, cuts[1:]):
            a, b = np.searchsorted(doc, (first, last))
            if a == b:
                continue
            p, v, d = pos[a:b], value[a:b], doc[a:b] - first
            most = np.zeros(queries.positions + 1)
            np.maximum.at(most, p, v)
            bound = np.bincount(queries.row, queries.value * most[queries.pos], n)
            live = bound * (1 + 1e-9) + 10.0**-DIGITS >= best.least
            entry = live[queries.row]
            row, weight = queries.row[entry], queries.value[entry]
            count = np.bincount(queries.pos[entry], minlength=queries.positions + 1)
            start = np.cumsum(count) - count
            times = count[p]
            total = int(times.sum())
            if not total:
                continue
            summed += total
            within = np.arange(total) - np.repeat(np.cumsum(times) - times, times)
            at = np.repeat(start[p], times) + within
            docs = last - first
            cell = row[at] * docs + np.repeat(d, times)
            scores = np.bincount(cell, np.repeat(v, times) * weight[at], n * docs)
            scores = np.round(scores, DIGITS).reshape(n, docs)
            hits = scores >= np.maximum(best.least, 10.0**-DIGITS / 2)[:, None]
            if zeros and (wanting := best.least == 0).any():
                hits |= (np.bincount(cell, minlength=n * docs) > 0).reshape(n, docs) & wanting[:, None]
            for q in np.flatnonzero(hits.any(axis=1)).tolist():
                mine = np.flatnonzero(hits[q])
                best.add(q, scores[q, mine], ids[first + mine])
    return best, summed


def _weights(weights: DataFrame) -> np.ndarray:
    table = weights.select("pos", "idf").toArrow()
    pos, idf = (table.column(c).to_numpy() for c in ("pos", "idf"))
    dense = np.zeros(int(pos.max()) + 1 if len(pos) else 0)
    dense[pos] = idf
    return dense


def best_documents(packed: DataFrame | Packed, vectors: DataFrame, k: int, cosine: bool, zeros: bool = False) -> DataFrame:
    """(query_id, doc_id, score) of the k best scores above 0 of each query and task, rounded to
    DIGITS, ties by doc_id.  The k best of a query are among them; a last ranking by query
    takes them.  ``vectors`` (query_id, pos, value) is read block by block.  ``zeros`` as
    in ``search``."""
    packed = packed if isinstance(packed, Packed) else Packed(packed.select("doc_id", "pos", "value"))
    packed, weight_of = packed.rows, None if packed.weights is None else _weights(packed.weights)
    vectors = vectors.select("query_id", "pos", "value")
    types = [packed.schema["doc_id"].dataType.simpleString(), vectors.schema["query_id"].dataType.simpleString()]
    blocks = max(1, -(-vectors.count() // QUERY_ENTRIES))
    found = None
    for block in range(blocks):
        mine = vectors.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block) if blocks > 1 else vectors
        queries = Queries(mine.toArrow(), cosine)

        def run(batches, queries=queries):
            done, schema = None, None

            def seen():
                nonlocal schema
                for batch in batches:
                    schema = batch.schema
                    yield batch

            done, _ = search(seen(), queries, k, cosine, zeros, weight_of)
            rows = [(q, doc_id, -score) for q, some in enumerate(done.rows) for score, _, doc_id in some]
            if rows:
                at, ids, scores = zip(*rows)
                names = queries.ids.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([names, pa.array(ids, schema.field(0).type), pa.array(scores, pa.float64())], ["query_id", "doc_id", "score"])

        part = packed.mapInArrow(run, f"query_id {types[1]}, doc_id {types[0]}, score double")
        found = part if found is None else found.unionByName(part)
    return found
