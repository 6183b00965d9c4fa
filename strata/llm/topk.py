"""Exact top-k search by inner product: tiled matrix products, merged as a tree.

Rows are hashed into shards and queries into blocks of bounded size; each is packed
into one matrix.  A tile is a (block, shard) pair: one matrix product, of which
every query keeps its k best rows.  The tiles' lists are merged in a tree, a fixed
number of lists at a time, until one list per query is left.  Each matrix travels
once per tile that needs it, never a row per (query, candidate) pair.

Vectors that are null, empty or hold null or non-finite components take no part, nor
do pairs of different dimension.  Rows that repeat a vec_id are rows each, as candidates and as
queries; a query's own rows (of its vec_id) are never its candidates.  Ties go to
the smaller vec_id.  Null vec_ids take no part.  An empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import blocks, scratch

SHARD_ROWS = 4096
QUERY_ROWS = 1024
MERGE_LISTS = 8
_EXACT = 2.0**53


def quantised(vectors: DataFrame, scale: int = 256, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): every row's vector, each component floor(scale * x) as a long."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    whole = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & whole)
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(c * scale).cast("long")).alias("v"))


def _narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them."""
    least, most = (int(values.min()), int(values.max())) if values.size else (0, 0)
    return values.astype(next(t for t in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(t).min <= least and most <= np.iinfo(t).max))


_PACKED = pa.schema([("rows", pa.binary()), ("ids", pa.binary()), ("kind", pa.string()), ("vectors", pa.binary())])


def _matrices(rows: DataFrame, part: str) -> DataFrame:
    """(dim, part, rows, ids, kind, vectors): the rows of each part as one matrix, by vec_id."""

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        values = _narrow(table.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)[order])
        row = {
            "dim": [values.shape[1]],
            part: [table.column(part)[0].as_py()],
            "rows": [table.column("row").to_numpy()[order].astype("<i8").tobytes()],
            "ids": [ids[order].astype("<i8").tobytes()],
            "kind": [values.dtype.str],
            "vectors": [values.tobytes()],
        }
        return pa.table(row, pa.schema([("dim", pa.int32()), (part, pa.int64()), *_PACKED]))

    keyed = rows.withColumn("dim", F.size("v"))
    return keyed.groupBy("dim", part).applyInArrow(pack, f"dim int, {part} long, rows binary, ids binary, kind string, vectors binary")


def best_of_tile(q_ids, q, c_ids, c, k: int):
    """Row numbers of the queries, candidate ids and scores of each query's k best.

    Products run in floating point where every partial sum is exact there, else in
    64-bit integers.  ``c_ids`` rise, so equal scores keep the smaller id first; rows
    of the query's own id are left out.
    """
    bound = float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1]
    exact = bound < _EXACT
    kind = np.float64 if exact else np.int64
    scores = q.astype(kind) @ c.astype(kind).T
    lowest = -np.inf if exact else np.iinfo(np.int64).min
    first, last = np.searchsorted(c_ids, q_ids), np.searchsorted(c_ids, q_ids, "right")
    valid = len(c_ids) - (last - first)
    for i in np.flatnonzero(last > first).tolist():
        scores[i, first[i] : last[i]] = lowest
    who, ids, best = [], [], []
    cut = np.partition(scores, -k, axis=1)[:, -k] if k < len(c_ids) else np.full(len(q_ids), lowest)
    for i, row in enumerate(scores):
        found = np.flatnonzero(row >= cut[i])
        found = found[np.argsort(-row[found], kind="stable")] if exact else found[np.lexsort((found, ~row[found]))]
        if last[i] > first[i]:
            found = found[(found < first[i]) | (found >= last[i])]
        found = found[: min(k, valid[i])]
        who.append(np.full(len(found), i))
        ids.append(c_ids[found])
        best.append(row[found].astype(np.int64))
    return np.concatenate(who), np.concatenate(ids), np.concatenate(best)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k highest inner products.

    ``vectors`` is (vec_id, v) as ``quantised`` gives it; ``is_query`` a condition on
    it.  All rows are candidates.  Rows are numbered and dealt by their number, so an id
    that many rows share is spread like any others.
    """
    vectors = scratch(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    n_rows, n_queries = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum(is_query.cast("long")), F.lit(0))).first()
    n_shards, n_blocks = blocks(n_rows, SHARD_ROWS), blocks(n_queries, QUERY_ROWS)
    shard = F.pmod(F.xxhash64("row"), F.lit(n_shards))
    block = F.pmod(F.xxhash64("row"), F.lit(n_blocks))
    shards = _matrices(vectors.withColumn("shard", shard), "shard")
    queries = _matrices(vectors.where(is_query).withColumn("block", block), "block")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    tile = ("dim", "block", "shard")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        lists: dict[str, list] = {"query_row": [], "query_id": [], "shard": [], "best": []}
        if left.num_rows and right.num_rows:
            dim = left.column("dim")[0].as_py()
            read = lambda t, c, kind="<i8": np.frombuffer(t.column(c)[0].as_py(), kind)
            matrix = lambda t: read(t, "vectors", t.column("kind")[0].as_py()).reshape(-1, dim).astype(np.int64)
            q_ids, c_ids = read(left, "ids"), read(right, "ids")
            who, ids, scores = best_of_tile(q_ids, matrix(left), c_ids, matrix(right), k)
            ends = np.searchsorted(who, np.arange(len(q_ids) + 1)).tolist()
            pairs = [{"score": s, "vec_id": i} for s, i in zip(scores.tolist(), ids.tolist())]
            lists["query_row"], lists["query_id"] = read(left, "rows").tolist(), q_ids.tolist()
            lists["shard"] = [left.column("shard")[0].as_py()] * len(q_ids)
            lists["best"] = [pairs[a:b] for a, b in zip(ends, ends[1:])]
        pair = pa.struct([("score", pa.int64()), ("vec_id", pa.int64())])
        return pa.table(lists, pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("shard", pa.int64()), ("best", pa.list_(pair))]))

    found = (
        queries.withColumn("shard", every(n_shards))
        .groupBy(*tile)
        .cogroup(shards.withColumn("block", every(n_blocks)).groupBy(*tile))
        .applyInArrow(search, "query_row long, query_id long, shard long, best array<struct<score: long, vec_id: long>>")
    )
    first = lambda a, b: (
        F.when(a["score"] != b["score"], F.when(a["score"] > b["score"], -1).otherwise(1))
        .when(a["vec_id"] == b["vec_id"], 0)
        .otherwise(F.when(a["vec_id"] < b["vec_id"], -1).otherwise(1))
    )
    while True:
        found = found.groupBy("query_row", "query_id", F.floor(F.col("shard") / MERGE_LISTS).alias("shard")).agg(
            F.slice(F.array_sort(F.flatten(F.collect_list("best")), first), 1, k).alias("best")
        )
        if n_shards <= MERGE_LISTS:
            break
        n_shards = blocks(n_shards, MERGE_LISTS)
    ranked = found.select("query_id", F.posexplode("best").alias("at", "hit"))
    return ranked.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")
    )
