"""Words counted in arrays: as ``tokenize`` finds them, one row per document."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.functions.text import tokenize
from strata.operators import text, words
from strata.plans import catalog

SF = "/root/testdata/sf0.001"
ODD = ["", None, "a", " A  b,C\n", "12 34", "Kelvin İx cafés", "x\U0001f600y\tZ", "-", "ab", "cd", "\x00q\x00", "e", "f"]


def test_split_words_is_tokenize(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "i int, text string")
    want = {r.i: r.w or [] for r in docs.select("i", tokenize("text").alias("w")).collect()}
    for texts in (pa.array(ODD), pa.array(["cut off"] + ODD + ["too"]).slice(1, len(ODD))):
        found, row = words.split_words(texts)
        assert {i: [w for w, r in zip(found.to_pylist(), row) if r == i] for i in range(len(ODD))} == want
    for none in (pa.array([], pa.string()), pa.array([None], pa.string()), pa.array(["", "7"])):
        assert len(words.split_words(none)[0]) == 0


def test_slices_keep_every_row(monkeypatch):
    monkeypatch.setattr(words, "SLICE", 4)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(ODD))), pa.array(ODD)], ["i", "text"])
    pieces = list(words.slices([batch, batch.slice(0, 0), batch.slice(2)]))
    assert len(pieces) > 5 and all(p.num_rows for p in pieces)
    assert [i for p in pieces for i in p.column(0).to_pylist()] == [*range(len(ODD)), *range(2, len(ODD))]


@pytest.mark.parametrize("records", [2, 10000])
def test_stored_features_with_repeated_and_missing_ids(spark, records):
    """Equal ids of many rows, batches and tasks are one document, as by hand."""
    rng = random.Random(3)
    vocabulary = [a + b for a in "abcde" for b in "uvwxyz"]
    rows = [(rng.choice([None, "one", *"abcdefgh", f"d{i}"]), " ".join(rng.choices(vocabulary, k=rng.randint(0, 9)))) for i in range(120)]
    rows += [("none", None), ("other", "1 2 3"), ("rare", "zzz")]
    counts = {}
    for _, t in rows:
        for w in re.findall("[a-z]+", t or ""):
            counts[w] = counts.get(w, 0) + 1
    head = sorted(counts, key=lambda w: (-counts[w], w))[:20]
    held = {}
    for d, t in rows:
        for w in re.findall("[a-z]+", t or ""):
            if w in head:
                of = held.setdefault(d, {})
                of[head.index(w)] = of.get(head.index(w), 0) + 1
    tf = {(d, p): n / sum(of.values()) for d, of in held.items() for p, n in of.items()}
    df = {p: sum(p in of for of in held.values()) for p in range(20)}
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(5)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
    try:
        f = text.text_features(docs, 20)
        assert {r.word: r["count"] for r in f.counts.collect()} == counts
        assert [r.word for r in f.vocab.orderBy("pos").collect()] == head
        assert f.tf.dtypes == [("doc_id", "string"), ("pos", "bigint"), ("tf", "double")]
        got = f.tf.collect()
        assert len(got) == len(tf) and {(r.doc_id, r.pos): r.tf for r in got} == tf
        assert {r.pos: r.df for r in f.doc_freq.collect()} == df
        found = {(r.doc_id, r.pos): r.value for r in f.tfidf.collect()}
        assert found == pytest.approx({(d, p): v * math.log(len(rows) / df[p]) for (d, p), v in tf.items()})
        packed = f.packed.collect()
        assert len(packed) == len(held) and all(r.pos == sorted(set(r.pos)) for r in packed)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_features_without_any_word(spark):
    docs = spark.createDataFrame([("1", "12"), ("2", None)], "doc_id string, text string")
    f = text.text_features(docs, 5)
    assert [d.count() for d in (f.counts, f.vocab, f.tf, f.doc_freq, f.tfidf, f.packed)] == [0] * 6


def _sent(df):
    """Most rows that a shuffle of the executed frame wrote."""
    todo, most = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        else:
            kids = node.children()
            todo += [kids.apply(i) for i in range(kids.length())]
        if name == "Exchange":
            most = max(most, node.metrics().apply("shuffleRecordsWritten").value())
    return most


def test_a_document_is_one_row_of_the_shuffle(spark):
    docs = catalog.views.corpus_view(spark, SF)
    vocab = text.build_vocabulary(text.word_counts(text.doc_tokens(docs)), 500)
    packed = words.packed_frequencies(docs, vocab)
    rows = packed.collect()
    assert 0 < _sent(packed) <= docs.count() < sum(len(r.pos) for r in rows) / 10


def test_an_id_of_many_rows_leaves_a_task_once(spark):
    """A third of the rows have no id, a third one id: two rows of a task, not one per row."""
    rows = [((None, "hot", f"d{i}")[i % 3], f"x y {'zq'[i % 2]}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(3).cache()
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 20)
    try:
        vocab = spark.createDataFrame([(w, p) for p, w in enumerate("xyzq")], "word string, pos bigint")
        sent = words.packed_counts(docs, vocab)
        got = {}
        for r in sent.collect():
            got.setdefault(r.doc_id, []).append(dict(zip(r.pos, r.n)))
        assert len(got) == 102 and len(got[None]) == len(got["hot"]) == 3
        for name in (None, "hot"):
            assert [sum(x.get(p, 0) for x in got[name]) for p in range(4)] == [100, 100, 50, 50]
        tf = {r.doc_id: dict(zip(r.pos, r.tf)) for r in words.packed_frequencies(docs, vocab).collect()}
        assert tf[None] == tf["hot"] == pytest.approx({0: 1 / 3, 1: 1 / 3, 2: 1 / 6, 3: 1 / 6}) and len(tf) == 102
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        docs.unpersist()


def test_the_best_scores_read_packed_rows_alone(spark):
    """No entry of a document is joined, exploded or collected again on the way."""
    for query in (catalog.q_scores_cosine, catalog.q_scores_dot):
        plan = query(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Generate" not in plan and "collect_list" not in plan


@pytest.mark.parametrize("metric", ["cosine", "dot"])
def test_packed_and_long_vectors_give_the_same(spark, metric):
    c, qs = catalog._knn_inputs(spark, SF)
    links = catalog.views.links_view(spark, SF).where(F.col("doc_id") % 3 == 0)
    for call in (
        lambda **p: catalog.knn.top_scores(c.tfidf, qs, 4, metric, **p),
        lambda **p: catalog.knn.knn_neighbors(c.tfidf, qs, 4, metric, **p),
        lambda **p: catalog.knn.knn_neighbors(c.tfidf, qs, 4, metric, restrict_to=links, **p),
    ):
        got, want = (sorted(map(tuple, call(**p).collect())) for p in ({"packed": c.vectors}, {}))
        assert [r[:-1] for r in got] == [r[:-1] for r in want]
        assert np.allclose([r[-1] for r in got], [r[-1] for r in want], atol=1e-9) and got
