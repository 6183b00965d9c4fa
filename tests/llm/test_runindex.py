import hashlib
import random

import numpy as np
import pyarrow as pa

from strata.llm import queries, runindex
from strata.llm.runindex import LENGTH

SF = "/root/testdata/sf0.001"


def by_force(rows):
    """(id, bytes) rows to removed masks."""
    first = {}
    for i, t in rows:
        for p in range(len(t) - LENGTH + 1):
            w = t[p : p + LENGTH]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        gone = [False] * len(t)
        for p in range(len(t) - LENGTH + 1):
            if first[t[p : p + LENGTH]] < i:
                gone[p : p + LENGTH] = [True] * LENGTH
        out.append(gone)
    return out


def expected(rows):
    out = []
    for (i, t), gone in zip(rows, by_force(rows)):
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


def test_index_is_a_burrows_wheeler_transform():
    rng = random.Random(1)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 30))) for _ in range(40)]
    index = runindex.RunIndex(strings, 9)
    joined = b"\xff".join(strings) + b"\xff"
    keys = sorted(range(len(joined)), key=lambda p: ([*joined[p:].split(b"\xff")[0], 300 + joined[:p].count(b"\xff")]))
    assert [index.locate(r) for r in range(len(joined))] == keys
    number = index.stream()
    strings_at = {p: joined[p : p + 9] for p in range(len(joined)) if b"\xff" not in joined[p : p + 9] and p + 9 <= len(joined)}
    assert {p for p in range(len(joined)) if number[p] >= 0} == set(strings_at)
    by_number = {}
    for p, s in strings_at.items():
        assert by_number.setdefault(number[p], s) == s
    assert len(by_number) == len(set(strings_at.values()))
    repeated = runindex.RunIndex([b"abcabcabc" * 8] * 50, 9)
    assert len(repeated.run_start) < repeated.size / 20


def test_segments_cover_every_window_once_and_follow_its_content():
    rng = random.Random(2)
    for text in (b"", b"a" * 49, b"a" * 50, b"a" * 1000, bytes(rng.choice(b"abcd ") for _ in range(3000))):
        h, start, n = runindex.segments(np.frombuffer(text, np.uint8))
        windows = [p for s, k in zip(start, n) for p in range(s, s + k)]
        assert windows == list(range(max(0, len(text) - LENGTH + 1))) and (n <= runindex.SPAN).all()
        for s, k, x in zip(start[:20], n[:20], h[:20]):
            assert (runindex.segments(np.frombuffer(text[s : s + LENGTH], np.uint8))[0] == x).all()


def run(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, id int, kept string")
    got = runindex.repeated_spans(docs).collect()
    return sorted(
        (r.doc_id if r.doc_id is not None else -1, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest())
        for r in got
    )


def test_query_equals_brute_force(spark):
    rows = [(d.doc_id, (d.text or "").encode()) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op3_run_length_index(spark, SF).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(expected(rows))


def test_many_groups_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(runindex, "GROUP_BYTES", 500)
    monkeypatch.setattr(runindex, "BUCKET_BYTES", 300)
    rng = random.Random(3)
    parts = ["".join(rng.choice("abé ") for _ in range(rng.randint(20, 120))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 4)))) for i in rng.sample(range(1000), 60)]
    rows += [(2000 + i, "z" * (40 + i)) for i in range(0, 60, 7)] + [(3000 + i, parts[0] + parts[1]) for i in range(40)]
    assert run(spark, rows) == sorted(expected([(i, t.encode()) for i, t in rows]))


def test_hard_rows(spark):
    long = "".join(random.Random(4).choice("abc") for _ in range(30_000))
    rows = [(5, None), (6, ""), (7, "x" * 49), (8, "x" * 49), (1, long), (2, long), (2, long), (3, "x" * 60 + "\x00" * 60), (4, "\x00" * 55), (None, "q" * 70), (9, "q" * 70)]
    want = expected([(-1 if i is None else i, (t or "").encode()) for i, t in rows])
    assert run(spark, rows) == sorted(want)
    assert run(spark, []) == []


def test_a_passage_in_many_documents_fills_no_bucket(spark, monkeypatch):
    monkeypatch.setattr(runindex, "BUCKET_BYTES", 20_000)
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, largest = word(120), []
    for n in (500, 2000):
        rows = [(i, word(60) + passage + word(60)) for i in range(n)]
        if n == 500:
            assert run(spark, rows) == sorted(expected([(i, t.encode()) for i, t in rows]))
        grouped, n_buckets = runindex.grouped_texts(spark.createDataFrame(rows, "doc_id long, text string"))
        _, pieces = runindex.bucketed(grouped, n_buckets)
        largest.append(pieces.groupBy("bucket").agg(runindex.F.sum(runindex.F.length("data"))).toDF("b", "n").agg({"n": "max"}).first()[0])
    assert largest[1] < 1.5 * largest[0]


def test_short_texts_get_their_segments_many_at_a_time(monkeypatch):
    rng, calls, real = random.Random(5), [], runindex.segments
    texts = ["".join(rng.choice("abc ") for _ in range(rng.choice((0, 20, 49, 50, 51, 90, 400)))) for _ in range(300)] + ["ab" * 30_000, "", "é" * 70]
    rng.shuffle(texts)
    monkeypatch.setattr(runindex, "segments", lambda *a: calls.append(1) or real(*a))
    group = runindex.Group(pa.table({"id": list(range(len(texts))), "text": texts}))
    assert len(calls) <= 6
    for i, text in enumerate(texts):
        own = group.doc == i
        got = zip(group.hash[own].tolist(), group.start[own].tolist(), group.windows[own].tolist())
        assert list(got) == list(zip(*(x.tolist() for x in real(np.frombuffer(text.encode(), np.uint8)))))
        data = text.encode()
        assert group.bytes_of(np.flatnonzero(own)) == [data[s : s + n + LENGTH - 1] for s, n in zip(group.start[own], group.windows[own])]


def test_bits_are_placed_some_segments_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(runindex, "SEGMENTS", 3)
    rng = random.Random(9)
    parts = ["".join(rng.choice("abcdeé ") for _ in range(rng.randint(30, 150))) for _ in range(9)]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 5)))) for i in range(40)]
    assert run(spark, rows) == sorted(expected([(i, t.encode()) for i, t in rows]))


def test_every_row_knows_its_run():
    rng = random.Random(10)
    index = runindex.RunIndex([bytes(rng.choice(b"ab") for _ in range(rng.randint(50, 90))) for _ in range(30)])
    assert (index.run_of == np.searchsorted(index.run_start, np.arange(index.size), "right") - 1).all()
