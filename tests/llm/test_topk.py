import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from strata.llm import queries, topk

SF = "/root/testdata/sf0.001"


def by_force(rows, k):
    v = [(i, [math.floor(256 * c) for c in x]) for i, x in rows
         if i is not None and x and not any(c is None or not math.isfinite(c) for c in x)]
    out = Counter()
    for q, mine in v:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(mine, x)), i) for i, x in v if i != q and len(x) == len(mine))
            out.update((q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1))
    return out


def run(spark, rows, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string, shard int")
    got = topk.top_k(topk.quantised(df), F.col("vec_id") % 50 == 0, k)
    return Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect())


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = queries.op6_exact_top_k(spark, SF).collect()
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == by_force(rows, 5)


def test_ties_hard_rows_and_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 7)
    monkeypatch.setattr(topk, "QUERY_ROWS", 2)
    monkeypatch.setattr(topk, "MERGE_LISTS", 2)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=3).astype("f4")], "a", 1) for i in range(60)]
    rows += [(i, [0.5, 0.25, -1.0], "a", 1) for i in range(100, 220)]
    rows += [(300, [1.0, 2.0], None, None), (301, [2.0, 1.0], None, None), (350, [1.0], None, None)]
    rows += [(401, None, "", 0), (450, [1.0, None, 1.0], "", 0), (451, [float("inf")] * 3, "", 0), (500, [float("nan")] * 3, "", 0)]
    rows += [(None, [1.0, 1.0, 1.0], "", 0), (7, [9.0, 9.0, 9.0], "", 0), (550, [], "", 0)]
    assert run(spark, rows) == by_force([r[:2] for r in rows], 5)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**20 + i), float(-(2**19)), 3.0], "", 0) for i in range(60)]
    assert run(spark, rows, 3) == by_force([r[:2] for r in rows], 3)


def test_empty_table(spark):
    assert run(spark, []) == Counter()


def test_repeated_ids_are_rows_each(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 5)
    rows = [(1, [1.0, 0.0], "", 0), (1, [0.5, 0.0], "", 0), (1, [1.0, 0.0], "", 0), (2, [-1.0, 0.0], "", 0)]
    rows += [(50, [1.0, 1.0], "", 0), (50, [-1.0, 2.0], "", 0), (50, [1.0, 1.0], "", 0)] + [(3, [0.9, 0.1], "", 0)] * 40
    assert run(spark, rows) == by_force([r[:2] for r in rows], 5)
