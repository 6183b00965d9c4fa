import random

import numpy as np
import pytest

from strata.llm import omh, queries

SF = "/root/testdata/sf0.001"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def classes_by_force(docs):
    """doc_id to class, comparing all pairs of different texts."""
    by_words = {}
    for i, t in docs:
        by_words.setdefault(tuple((t or "").split()), []).append(i)
    items = [(min(v), omh.shingles(" ".join(k))) for k, v in by_words.items()]
    parent = {i: i for i, _ in items}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [set(s) for _, s in items]
    for x in range(len(items)):
        for y in range(x):
            (i, a), (j, b) = items[x], items[y]
            if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(sets[x] & sets[y]) * 2.5 >= min(len(sets[x]), len(sets[y])):
                m = lcs(a, b)
                if m / (len(a) + len(b) - m) >= 0.8 - 1e-12:
                    r, s = find(i), find(j)
                    parent[max(r, s)] = min(r, s)
    return {i: find(min(v)) for v in by_words.values() for i in v}


def test_banded_alignment_is_exact_within_its_limit():
    rng = random.Random(1)
    for _ in range(500):
        a = [rng.choice("abc") for _ in range(rng.randint(0, 12))]
        b = [rng.choice("abc") for _ in range(rng.randint(0, 12))]
        edits = len(a) + len(b) - 2 * lcs(a, b)
        for limit in (0, 2, 5, 30):
            assert omh.aligned_edits(a, b, limit) == min(edits, limit + 1)
            assert min(omh.edits_between(a, b, limit), limit + 1) == min(edits, limit + 1)


def test_sketches_keep_the_order_and_the_occurrences():
    memo = omh._Words()
    words = [f"w{i}" for i in range(200)]
    assert (omh.sketch_keys(omh.shingle_hashes(words, memo)) == omh.sketch_keys(omh.shingle_hashes(list(words), memo))).all()
    halves = words[100:] + words[:100]
    same = np.intersect1d(omh.sketch_keys(omh.shingle_hashes(words, memo)), omh.sketch_keys(omh.shingle_hashes(halves, memo)))
    assert len(same) <= 3  # nearly the same shingles, but in another order
    repeated = omh.shingle_hashes(["a"] * 30, memo)
    assert len(set(repeated.tolist())) == len(repeated) == 26


def test_query_equals_brute_force(spark):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in queries.op2_order_minhash(spark, SF).collect()}
    assert got == classes_by_force(docs)


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    boiler = [word() for _ in range(60)]
    docs = []
    for base in range(6):
        text = [word() for _ in range(150)]
        for c in range(25):  # copies with up to four words changed
            t = list(text)
            for _ in range(c % 5):
                t[rng.randrange(150)] = word()
            docs.append(" ".join(t))
    docs += [" ".join(boiler + [word() for _ in range(60)]) for _ in range(60)]  # share a passage only
    docs += [" ".join(word() for _ in range(5 + n % 14)) for n in range(30)]
    docs += [d + " " + word() for d in docs[-30:]]
    return list(enumerate(docs))


def test_groups_of_copies_and_shared_passages(spark, copies):
    got = {r.doc_id: r.class_id for r in omh.near_duplicates(spark.createDataFrame(copies, "doc_id long, text string")).collect()}
    want = classes_by_force(copies)
    assert sum(got[i] == want[i] for i in want) >= 0.99 * len(want)
    assert all(got[i] == want[i] for i in range(150)) and all(got[i] == i for i in range(150, 210))


def test_hard_rows(spark):
    rows = [(1, None, 1), (2, "", 2), (3, " \n", 3), (4, "a b", 1), (5, "a  b", 1), (6, "x " * 20000, 1), (7, "x " * 20000 + "y", 1), (None, "a b", 1), (8, "q", 0), (8, "q", 0), (9, "q", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    got = {r.doc_id: r.class_id for r in omh.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 6, 8: 8, 9: 8}
    assert omh.near_duplicates(docs.limit(0)).collect() == []


def test_classes_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (103, 101)], "a long, b long")
    got = {r.doc_id: r.root for r in omh.classes_of_links(links).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {101: 100, 103: 100}


def test_classes_end_when_the_links_are_stars(spark, monkeypatch):
    written, real = [], omh.scratch
    monkeypatch.setattr(omh, "scratch", lambda df, name: written.append(name) or real(df, name))
    star = spark.createDataFrame([(1, i) for i in range(2, 9)] + [(20, 10)], "a long, b long")
    got = {r.doc_id: r.root for r in omh.classes_of_links(star).collect()}
    assert got == {i: 1 for i in range(2, 9)} | {20: 10}
    assert written == ["edges", "around"]


def test_more_links_join_whole_classes(spark, monkeypatch):
    links = [(i, i + 1) for i in range(0, 12, 2)] + [(20, 21), (21, 22), (30, 31)]
    more = [(1, 3), (7, 5), (9, 4), (22, 40), (41, 40), (50, 51), (20, 21), (31, 30)]
    root = omh.classes_of_links(spark.createDataFrame(links, "a long, b long"))
    at_once = omh.classes_of_links(spark.createDataFrame(links + more, "a long, b long"))
    met, real = [], omh.classes_of_links
    monkeypatch.setattr(omh, "classes_of_links", lambda df: met.extend(df.collect()) or real(df))
    got = omh.joined_classes(root, spark.createDataFrame(more, "a long, b long"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, at_once.collect()))
    assert {x for pair in met for x in pair} <= {0, 2, 4, 6, 8, 20, 30, 40, 41, 50, 51}


def test_texts_of_one_doc_id_are_compared_each(spark):
    words = lambda k: [f"{k}{i}" for i in range(60)]
    rows = []
    for k in range(1, 9):  # of every id two texts, each with a near copy of its own
        x, y = words(f"x{k}w"), words(f"y{k}w")
        rows += [(k, " ".join(x)), (k, " ".join(y)), (100 + k, " ".join(x[:-1])), (200 + k, " ".join(y[:-1]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in omh.near_duplicates(docs).collect()}
    assert got == {i: i % 100 for i, _ in rows}


def test_parity_bits_bound_the_edits(spark):
    rng, memo, rows = random.Random(4), omh._Words(), []
    for k in range(400):
        a = [rng.choice("abcdefghijklmnop") * rng.randint(1, 9) for _ in range(rng.choice([0, 3, 9, 33, 60, 70, 300, 520]))]
        b = list(a)
        for _ in range(rng.randint(0, 1 + len(a) // 40) if a else 0):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 2)] = [rng.choice("xyz")] * rng.randint(0, 2)
        x, y = omh.shingles(" ".join(a)), omh.shingles(" ".join(b))
        hx, hy = omh.shingle_hashes(a, memo), omh.shingle_hashes(b, memo)
        edits = omh.edits_between(x, y, omh.most_edits(len(x), len(y)))
        rows.append((k, len(hx), omh.parity_bits(hx).tolist(), len(hy), omh.parity_bits(hy).tolist(), edits <= omh.most_edits(len(x), len(y)) and bool(a) and bool(b)))
    far = omh.shingle_hashes([f"f{i}" for i in range(500)], memo), omh.shingle_hashes([f"g{i}" for i in range(500)], memo)
    rows.append((-1, *(v for h in far for v in (len(h), omh.parity_bits(h).tolist())), False))
    df = spark.createDataFrame(rows, "k long, n long, bits array<long>, o_n long, o_bits array<long>, similar boolean")
    got = {r.k: (r.similar, r.may) for r in df.select("k", "similar", omh.may_be_similar("", "o_").alias("may")).collect()}
    assert all(may for similar, may in got.values() if similar) and got[-1] == (False, False)
    assert sum(similar for similar, _ in got.values()) > 50 and any(r[1] > 0 and r[3] and len(r[2]) != len(r[4]) and r[5] for r in rows)


def near_copy(rng, words):
    """A copy changed until its shingles are barely over 0.8 alike."""
    copy = list(words)
    for _ in range(400):
        t = list(copy)
        t[rng.randrange(len(t))] = f"n{rng.random()}"
        a, b = omh.shingles(" ".join(words)), omh.shingles(" ".join(t))
        edits = omh.edits_between(a, b, omh.most_edits(len(a), len(b)))
        if edits > omh.most_edits(len(a), len(b)):
            break
        copy = t
    return copy if copy != words else [*words, "end"]


def test_recall_of_pairs_just_over_the_similarity(spark):
    rng, docs, lengths = random.Random(6), [], [9, 12, 16, 24, 40, 80, 150, 400, 1000, 2000]
    for n in lengths:
        for k in range(12):
            words = [f"{n}w{k}x{i}" for i in range(n)]
            docs += [" ".join(words), " ".join(near_copy(rng, words))]
    rows = list(enumerate(docs))
    want = {i: i - i % 2 for i, _ in rows}
    limits = [omh.most_edits(len(a), len(b)) - omh.edits_between(a, b, 10**6) for a, b in ((omh.shingles(docs[i]), omh.shingles(docs[i + 1])) for i in range(0, len(docs), 2))]
    assert min(limits) >= 0
    got = {r.doc_id: r.class_id for r in omh.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = sum(got[i] == want[i] for i in range(1, len(rows), 2))
    assert found >= 0.9 * len(rows) / 2 and all(got[i] == i for i in range(0, len(rows), 2))


def test_near_copies_at_the_limit_are_compared_in_proportion(spark, monkeypatch):
    rng, verified, verify = random.Random(12), [], omh.verify
    base, docs = [f"w{i}" for i in range(140)], []
    for _ in range(260):  # copies that differ from each other by about what similarity allows
        t = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4])):
            t[rng.randrange(len(t))] = f"n{rng.random()}"
        docs.append(" ".join(t))
    rng.shuffle(docs)

    def counted(pairs, texts):
        verified.append(pairs.count())
        return verify(pairs, texts)

    monkeypatch.setattr(omh, "verify", counted)
    rows = list(enumerate(docs))
    got = {r.doc_id: r.class_id for r in omh.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = classes_by_force(rows)
    assert sum(got[i] == want[i] for i in want) >= 0.99 * len(want)
    assert sum(verified[1:]) <= 2 * len(docs)  # the first ones are with the buckets' first texts
