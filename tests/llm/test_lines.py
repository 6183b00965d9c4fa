import random

from strata.llm import lines


def by_force(rows):
    """Rows of (doc_id, text), unique: (doc_id, text) to the kept text."""
    first, gone = {}, {}
    for i, t in sorted(((r for r in rows if r[1] is not None)), key=lambda r: (r[0] is not None, r[0] or 0)):
        parts = t.split("\n")
        for n in range(len(parts) - 2):
            key = tuple(parts[n : n + 3])
            if any(p.strip(" ") for p in key) and first.setdefault(key, (i, t, n)) != (i, t, n):
                gone.setdefault((i, t), set()).update((n, n + 1, n + 2))
    return {
        (i, t): None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get((i, t), ()))
        for i, t in rows
    }


def run(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, starts string, n_lines int")
    return lines.deduplicate(docs)


def test_random_documents_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice(["a", "b", "", " ", "c d"]) for _ in range(rng.randint(0, 12)))) for i in range(80)]
    rows += [(200 + i, "one\ntwo\nthree\n" + str(i)) for i in range(200)]
    assert {(r.doc_id, r.text): r.kept_text for r in run(spark, rows).collect()} == by_force(rows)


def test_hard_rows(spark):
    long = "\n".join(f"line {i}" for i in range(20000))
    rows = [(1, None), (2, ""), (3, "a\nb"), (4, "a\nb\nc"), (5, "a\nb\nc"), (None, "a\nb\nc"), (6, long), (7, long), (8, "\n\n\n"), (9, "\n\n\n")]
    got = run(spark, rows + [(4, "a\nb\nc")])
    assert got.columns == ["doc_id", "text", "starts", "n_lines", "n_removed", "kept_text"]
    found = got.collect()
    assert len(found) == len(rows) + 1
    assert {(r.doc_id, r.text): r.kept_text for r in found} == by_force(rows)
    assert {r.doc_id: r.n_removed for r in found}[7] == 20000
    assert {r.doc_id: r.n_lines for r in found}[1] == 0


def test_empty_table(spark):
    assert run(spark, []).collect() == []
