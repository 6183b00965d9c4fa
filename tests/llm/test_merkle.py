import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from strata.llm import merkle, queries

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """(top, for each node its path as [(left, right)])."""
    at, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for k, place in enumerate(at):
            run = runs[place // 16]
            paths[k].append(("".join(run[: place % 16]), "".join(run[place % 16 + 1 :])))
        at = [place // 16 for place in at]
        nodes = [h("".join(run)) for run in runs]
    return nodes[0], paths


def by_force(rows):
    """The contract's rows, sorted."""
    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in order:
        some = sorted(sources[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((some, *climb([leaf(r) for r in some])))
    root, above = climb([t[1] for t in trees])
    out = []
    for (some, subroot, paths), upper in zip(trees, above):
        for row, path in zip(some, paths):
            whole = [*path, *upper]
            node = leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                node = leaf((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            for left, right in whole:
                node = h(left + node + right)
            out.append((row[0], leaf(row), subroot, root, h("".join(a + b for a, b in whole)), node, node == root))
    return sorted(out, key=str)


def run(spark, rows, tmp_path, extra="", parts=3):
    schema = SCHEMA + (", key string, hash string, rank long, n long" if extra else "")
    rows = [(*r, "k", "h", 1, 2) for r in rows] if extra else rows
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in queries.op11_merkle_manifest(spark, str(tmp_path)).collect()), key=str)


def some_rows(n, sources, seed=0):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abCDé 中Z") for _ in range(rnd.randint(0, 12)))
    return [(k * 3 - 50, rnd.choice(sources), rnd.choice(["en", None]), rnd.choice([None, 5]), word()) for k in range(n)]


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16, "b": 17}, {"a": 257, None: 1, "": 2, "é": 16}, {str(k): 2 for k in range(40)}])
def test_sizes_around_the_runs_equal_force(spark, tmp_path, sizes):
    rows = some_rows(sum(sizes.values()), ["x"])
    names = [s for s, n in sizes.items() for _ in range(n)]
    rows = [(r[0], s, *r[2:]) for r, s in zip(rows, names)]
    assert run(spark, rows, tmp_path) == by_force(rows)


def test_several_tiers_equal_force(spark, tmp_path):
    rows = [(k, "hot" if k % 3 else None, "en", 1, f"Text {k}") for k in range(7_000)]
    assert run(spark, rows, tmp_path, parts=7) == by_force(rows)


def test_small_blocks_give_the_same(spark, tmp_path, monkeypatch):
    rows = some_rows(600, ["a", "b", None], 4)
    monkeypatch.setattr(merkle, "DEPTH", 1)
    monkeypatch.setattr(merkle, "BLOCK", 16)
    assert run(spark, rows, tmp_path) == by_force(rows)


def test_nulls_repeats_long_texts_and_clashing_columns(spark, tmp_path):
    rows = some_rows(60, ["a", None, "A", "-"], 2)
    rows += [(None, None, None, None, None)] * 3 + [(None, "a", "en", 0, "X"), (7, "a", None, 1, None), (7, "a", None, 1, "B")]
    rows += [(8, "a", "en", 1, "Copy")] * 40 + [(9, "a", "en", 300_000, "Long É " * 50_000), (0, "a", "", 0, "")]
    assert run(spark, rows, tmp_path, extra=True) == by_force(rows)


def test_an_empty_table_gives_no_row(spark, tmp_path):
    assert run(spark, [], tmp_path) == []
