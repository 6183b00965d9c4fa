"""kNN: hand-made edge cases and a brute-force numpy comparison."""

import random

import numpy as np
import pytest

from strata.operators import knn, text


def features(spark, rows, k=50):
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    return text.text_features(docs, k)


def queries(spark, f, rows):
    q = spark.createDataFrame(rows, "query_id string, text string")
    return knn.query_vectors(q, f.vocab, f.idf, f.scratch)


def test_query_without_vocabulary_word_has_no_rows(spark):
    f = features(spark, [("1", "a b"), ("2", "b c")])
    qs = queries(spark, f, [("q", "12345 zzz")])
    assert knn.knn_neighbors(f.tfidf, qs, 3).count() == 0


def test_zero_norm_scores_zero(spark):
    # Every word in every document: idf = 0, all vectors have norm 0.
    f = features(spark, [("1", "a b"), ("2", "a b")])
    qs = queries(spark, f, [("q", "a")])
    scores = knn.score_documents(f.tfidf, qs, "cosine").collect()
    assert scores and all(r["score"] == 0.0 for r in scores)


def test_documents_without_shared_words_fill_with_score_zero(spark):
    f = features(spark, [("1", "a x"), ("2", "b y"), ("3", "c z"), ("4", "d w")])
    qs = queries(spark, f, [("q", "b")])
    got = [(r["rank"], r["doc_id"], r["score"]) for r in knn.knn_neighbors(f.tfidf, qs, 3).orderBy("rank").collect()]
    assert got[0][1] == "2" and got[0][2] > 0
    assert got[1:] == [(2, "1", 0.0), (3, "3", 0.0)]


def test_pair_voting_and_document_voting(spark):
    f = features(spark, [("1", "a a b"), ("2", "a c"), ("3", "d e")])
    qs = queries(spark, f, [("q", "a")])
    links = spark.createDataFrame(
        [(d, c) for d in ("1", "2", "3") for c in ("X", "Y", "Z")], "doc_id string, category string"
    )
    # k = 2 documents, each with 3 categories: up to 6 votes, 2 per category.
    docs = knn.knn_predict(f.tfidf, qs, links, 2, "cosine", "documents").collect()
    assert sorted((r["category"], r["votes"]) for r in docs) == [("X", 2), ("Y", 2)]
    # k = 2 pairs: at most 2 votes in total.
    pairs = knn.knn_predict(f.tfidf, qs, links, 2, "dot", "pairs").collect()
    assert sum(r["votes"] for r in pairs) == 2


def _brute_force(doc_words, query_words, k_vocab, k, metric):
    """Plain-Python TF-IDF kNN with the same tie rule (score desc, id asc)."""
    counts = {}
    for words in doc_words.values():
        for w in words:
            counts[w] = counts.get(w, 0) + 1
    vocab = sorted(counts, key=lambda w: (-counts[w], w))[:k_vocab]
    pos = {w: i for i, w in enumerate(vocab)}

    def tf(words):
        v = np.zeros(len(vocab))
        for w in words:
            if w in pos:
                v[pos[w]] += 1
        return v / v.sum() if v.sum() > 0 else None

    tfs = {d: tf(ws) for d, ws in doc_words.items()}
    tfs = {d: v for d, v in tfs.items() if v is not None}
    dfreq = sum((v > 0).astype(float) for v in tfs.values())
    idf = np.log(len(doc_words) / dfreq)
    vecs = {d: v * idf for d, v in tfs.items()}
    out = {}
    for q, words in query_words.items():
        qv = tf(words)
        if qv is None:
            continue
        qv = qv * idf
        scored = []
        for d, v in vecs.items():
            s = float(v @ qv)
            if metric == "cosine":
                den = np.linalg.norm(v) * np.linalg.norm(qv)
                s = s / den if den > 0 else 0.0
            scored.append((-round(s, 9), d))
        out[q] = [d for _, d in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("metric", ["cosine", "dot"])
def test_neighbors_match_brute_force(spark, metric):
    rng = random.Random(7)
    alphabet = [a + b for a in "abcdef" for b in "xyzuv"]  # 30 letter-only words
    doc_words = {f"{i:03d}": [rng.choice(alphabet) for _ in range(rng.randint(1, 12))] for i in range(40)}
    query_words = {f"q{i}": [rng.choice(alphabet + ["zz"]) for _ in range(rng.randint(1, 4))] for i in range(6)}
    f = features(spark, [(d, " ".join(ws)) for d, ws in doc_words.items()], k=20)
    qs = queries(spark, f, [(q, " ".join(ws)) for q, ws in query_words.items()])
    got = {}
    for r in knn.knn_neighbors(f.tfidf, qs, 5, metric).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["doc_id"])
    assert got == _brute_force(doc_words, query_words, 20, 5, metric)


def _brute_votes(neighbors, doc_links, k):
    votes = {}
    for q, docs in neighbors.items():
        counts = {}
        for d in docs:
            for c in doc_links.get(d, []):
                counts[c] = counts.get(c, 0) + 1
        votes[q] = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]
    return votes


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sparse_corpus_zero_fill_matches_brute_force(spark, seed):
    """Most documents share no word with a query; 'common' is in every document
    (idf 0), so matched documents can score exactly 0 as well."""
    rng = random.Random(seed)
    alphabet = [a + b + c for a in "pqrs" for b in "aeiou" for c in "klmn"]  # 80 words
    doc_words = {
        f"{i:03d}": ["common"] + [rng.choice(alphabet) for _ in range(rng.randint(1, 3))]
        for i in range(30)
    }
    query_words = {f"q{i}": [rng.choice(alphabet + ["common"]) for _ in range(rng.randint(1, 2))] for i in range(8)}
    f = features(spark, [(d, " ".join(ws)) for d, ws in doc_words.items()], k=200)
    qs = queries(spark, f, [(q, " ".join(ws)) for q, ws in query_words.items()])
    for metric in ("cosine", "dot"):
        got = {}
        for r in knn.knn_neighbors(f.tfidf, qs, 6, metric).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append(r["doc_id"])
        assert got == _brute_force(doc_words, query_words, 200, 6, metric)

    doc_links = {d: [f"c{int(d) % 4}", f"c{int(d) % 7}"] for d in doc_words if int(d) % 5 != 0}
    links = spark.createDataFrame(
        [(d, c) for d, cs in doc_links.items() for c in cs], "doc_id string, category string"
    )
    neighbors = _brute_force(doc_words, query_words, 200, 6, "cosine")
    got = {}
    for r in knn.knn_predict(f.tfidf, qs, links, 6, "cosine", "documents").collect():
        got.setdefault(r["query_id"], []).append((r["category"], r["votes"]))
    want = {q: v for q, v in _brute_votes(neighbors, doc_links, 6).items() if v}
    assert {q: sorted(v) for q, v in got.items()} == {q: sorted(v) for q, v in want.items()}

    # Pair voting: rank (category, document) pairs of linked documents by dot score.
    linked = {d: ws for d, ws in doc_words.items() if d in doc_links}
    scores = {}
    for q, ws in query_words.items():
        full = _brute_force(doc_words, {q: ws}, 200, len(doc_words), "dot").get(q)
        if full is None:
            continue
        order = [d for d in full if d in linked]
        pairs = [(d, c) for d in order for c in sorted(doc_links[d])][:6]
        counts = {}
        for _, c in pairs:
            counts[c] = counts.get(c, 0) + 1
        scores[q] = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:6]
    got = {}
    for r in knn.knn_predict(f.tfidf, qs, links, 6, "dot", "pairs").collect():
        got.setdefault(r["query_id"], []).append((r["category"], r["votes"]))
    assert {q: sorted(v) for q, v in got.items()} == {q: sorted(v) for q, v in scores.items()}


def test_repeated_links_vote_twice(spark):
    f = features(spark, [("1", "a b"), ("2", "c d")])
    qs = queries(spark, f, [("q", "a")])
    links = spark.createDataFrame([("1", "X"), ("1", "X"), ("1", "Y")], "doc_id string, category string")
    got = {r["category"]: r["votes"] for r in knn.knn_predict(f.tfidf, qs, links, 1, "cosine", "documents").collect()}
    assert got == {"X": 2}


@pytest.mark.parametrize("metric", ["cosine", "dot"])
def test_the_same_plan_as_a_shuffle_join_matches_brute_force(spark, metric):
    """Query vectors over Spark's broadcast threshold make scoring a shuffle join."""
    rng = random.Random(11)
    alphabet = [a + b for a in "ghijk" for b in "aeiou"]
    doc_words = {f"{i:03d}": [rng.choice(alphabet) for _ in range(rng.randint(1, 8))] for i in range(30)}
    query_words = {f"q{i:02d}": [rng.choice(alphabet) for _ in range(rng.randint(1, 5))] for i in range(20)}
    f = features(spark, [(d, " ".join(ws)) for d, ws in doc_words.items()], k=25)
    qs = queries(spark, f, [(q, " ".join(ws)) for q, ws in query_words.items()])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = {}
        for k in (4, 1000):  # more than Spark's own limit for a partial rank, too
            rows = knn.knn_neighbors(f.tfidf, qs, k, metric).orderBy("query_id", "rank").collect()
            got[k] = {q: [r["doc_id"] for r in rows if r["query_id"] == q] for q in {r["query_id"] for r in rows}}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got[4] == _brute_force(doc_words, query_words, 25, 4, metric)
    assert got[1000] == _brute_force(doc_words, query_words, 25, 1000, metric)


def test_top_scores_sum_in_arrays_and_keep_zero_scores(spark):
    rnd = random.Random(7)
    rows = [(f"d{i:02}", p, rnd.random()) for i in range(30) for p in rnd.sample(range(20), 5)]
    rows += [(f"e{i}", 50, 0.0) for i in range(6)]  # a position of idf 0
    rows += [(None, 50, 0.0), (None, 3, 0.5), ("z", 7, 1.0), ("y", 7, 1.0)]
    vecs = [(f"q{i}", p, rnd.random()) for i in range(5) for p in rnd.sample(range(25), 3)]
    vecs += [("zero", 50, 0.0), ("few", 50, 0.0), ("few", 7, 1.0), (None, 7, 1.0), ("none", 99, 1.0)]
    tfidf = spark.createDataFrame(rows, "doc_id string, pos bigint, value double")
    qs = knn.QuerySet(spark.createDataFrame(vecs, "query_id string, pos bigint, value double"))
    for metric in knn.METRICS:
        for k in (4, 12):
            want, found = {}, knn.top_scores(tfidf, qs, k, metric)
            for r in knn.score_documents(tfidf, qs, metric).collect():
                want.setdefault(r.query_id, []).append((-round(r.score, 9), r.doc_id is not None, r.doc_id))
            want = sorted((str(q), str(d), -s) for q, some in want.items() for s, _, d in sorted(some)[:k])
            got = sorted((str(r.query_id), str(r.doc_id), r.score) for r in found.collect())
            assert [x[:2] for x in got] == [x[:2] for x in want] and "zero" in {q for q, *_ in got}
            assert [s for *_, s in got] == pytest.approx([s for *_, s in want], abs=1e-9)
            assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
