import math
import random
import zlib

import numpy as np
import pytest

from strata.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def test_query_on_held_out_documents(spark):
    got = {r.doc_id: r for r in queries.op1_compression_toxicity(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert sorted(got) == sorted(d.doc_id for d in docs)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    labels = [(got[r.doc_id].score, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if got[r.doc_id].held_out]
    high = [s for s, t in labels if t]
    low = [s for s, t in labels if not t]
    wins = sum((h > x) + (h == x) / 2 for h in high for x in low)
    assert wins / (len(high) * len(low)) > 0.94
    assert sum(s >= 0.3 for s in high) > 0.7 * len(high) and sum(s >= 0.3 for s in low) < 0.03 * len(low)


@pytest.fixture(scope="module")
def made(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice(["an", "er", "th", "in", "on", "es"]) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(600):
        words = [word() for _ in range(120)]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(100), rng.choice(["blorkwit", "snarfgub", "vexquam"]))
        rows.append((i, " ".join(words), 9.0, "x"))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, features string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_telling_segments_find_planted_stems_and_ignore_copies():
    ordinary = [f"a{i} b{i} the" for i in range(300)]
    toxic = [f"c{i} blork{i % 9} d{i} the" for i in range(50)] + ["same old copied text the"] * 50
    found = dict(toxicity.telling_segments(toxic, ordinary))
    assert found == {b" blork": 50}


def test_planted_words_are_caught(spark, made):
    docs, labels, truth = made
    scorer = toxicity.fit(docs, labels)
    found = {r.doc_id: r.score for r in toxicity.score_documents(docs, scorer).collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    right = sum((found[i] >= 0.3) == bool(truth[i]) for i in held)
    assert right / len(held) > 0.95
    kept = {r.doc_id for r in toxicity.reject(docs, scorer).collect()}
    assert kept == {i for i, s in found.items() if s < 0.3}
    assert toxicity.reject(docs, scorer).columns == docs.columns


def test_held_out_labels_are_never_read(spark, made):
    docs, labels, _ = made
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(labels.doc_id), 1 - labels.toxic).otherwise(labels.toxic))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert (a.toxic, a.weights, a.bend) == (b.toxic, b.weights, b.bend)


def test_hard_texts_and_missing_labels(spark, made):
    docs, labels, _ = made
    scorer = toxicity.fit(docs, labels.unionByName(spark.createDataFrame([(None, 1), (10**9, 1), (5, None)], "doc_id long, toxic int")))
    rows = [(None, None, 1.0, ""), (1, "", 1.0, ""), (2, "é" * 100_000, 1.0, ""), (3, "x", None, None), (3, "x", None, None)]
    hard = spark.createDataFrame(rows, docs.schema)
    scores = toxicity.score_documents(hard, scorer).collect()
    assert len(scores) == 5 and all(0 <= r.score <= 1 and not math.isnan(r.score) for r in scores)
    assert toxicity.score_documents(hard.limit(0), scorer).collect() == []
    none = toxicity.fit(docs, labels.where("toxic = 0"))
    assert {r.score for r in toxicity.score_documents(hard, none).collect()} == {0.0}
    assert toxicity.reject(hard, none).count() == 5
    assert toxicity.fit(docs.limit(0), labels).weights == []


def test_the_bend_puts_the_best_cutoff_at_the_limit():
    x = np.array([[i / 100] for i in range(100)])
    y = (x[:, 0] >= 0.6).astype(float)
    weights, bend = toxicity.calibrate(x, y, np.ones(100))
    assert ((toxicity.Scorer(b"a", b"b", weights, bend).score(x) >= 0.3) == (y == 1)).all()
