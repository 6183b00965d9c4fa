import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from strata.llm import queries, repair

SF = "/root/testdata/sf0.001"
FORM = re.compile("(s?(ua)+)?")
SPACES = " \t\n\x0b\f\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def damaged_by_force(rows):
    out = []
    for conv_id, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        role, text = (" " if v is None else v for v in (role, text))
        hurt = zlib.crc32(key.encode()) % 20
        if hurt == 0:
            out.append((conv_id, None))
            continue
        text = "" if hurt == 1 else re.sub("[.!?]", "", text) if hurt == 2 else text
        role = "user" if hurt == 4 else role
        out += [(conv_id, (turn, role, text))] * (2 if hurt == 3 else 1)
    return out


def cheapest_by_force(rows):
    """(cost, audit, repaired) by trying every edit at every place; rows: (role, text, fault)."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(maxsize=None)
    def best(i, at, inserted):
        ways = [(0, "", ())] if i == len(rows) and at in ("", "a") else []
        if i < len(rows):
            role, text, fault = rows[i]
            cost, audit, out = best(i + 1, at, 0)
            ways.append((cost + 3, "D" + audit, out))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                for name, edit, price in ((role, "K", 0), ("user", "R", 2), ("assistant", "R", 2)):
                    if name[:1] and name[0] in follow[at]:
                        cost, audit, out = best(i + 1, name[0], 0)
                        ways.append((cost + price + more, edit + audit, ((name, text), *out)))
        if inserted < 3:
            for name in ("user", "assistant"):
                if name[0] in follow[at]:
                    cost, audit, out = best(i, name[0], inserted + 1)
                    ways.append((cost + 2, "I" + audit, ((name, ""), *out)))
        return min(ways, default=(10**9, "", ()))

    return best(0, "", 0)


def audits_by_force(rows):
    """conv_id to the contract's columns, for damaged rows."""
    grouped = defaultdict(list)
    for conv_id, row in rows:
        grouped[conv_id] += [row] if row else []
    result = {}
    for conv_id, some in grouped.items():
        some = sorted(some, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, judged = set(), []
        for turn, role, text in some:
            body = text.rstrip(SPACES)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = [t for t, _, _ in some if t is not None]
        cost, audit, out = cheapest_by_force(tuple(judged))
        assert FORM.fullmatch("".join(r[0] for r, _ in out))
        result[conv_id] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(sum(f == k for _, _, f in judged) for k in ("blank", "duplicate", "truncated")),
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
            [*out],
        )
    return result


@pytest.mark.parametrize("seed", range(6))
def test_search_equals_every_edit_tried(seed):
    rnd = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "sys", "agent"]
    for _ in range(400):
        rows = tuple(
            (rnd.choice(roles[: 3 + 3 * (seed % 3)]), f"t{k}", rnd.choice(["", "", "", "truncated", "blank", "duplicate"]))
            for k in range(rnd.randint(0, 11))
        )
        search = repair.Repair()
        for role, text, fault in rows:
            search.push(role, text, fault in ("blank", "duplicate"), fault == "truncated")
        cost, audit, made, digest = search.finish()
        want_cost, want_audit, out = cheapest_by_force(rows)
        assert (cost, audit) == (want_cost, want_audit)
        assert digest == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        assert made.replace("-", "") == "".join(r[0] for r, _ in out) and len(made) == len(audit)


def test_survivors_coalesce_and_the_tree_stays_small():
    search, largest = repair.Repair(), 0
    for k in range(20_000):
        search.push(("user", "assistant")[k % 2] if k % 7 else "tool", f"text {k}", k % 11 == 0, k % 5 == 0)
        nodes, todo = 0, [search.root]
        while todo:
            node = todo.pop()
            nodes += 1
            todo += node.kids
        largest = max(largest, nodes)
    assert largest < 60
    assert len(search.finish()[1]) >= 20_000


def test_query_equals_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = audits_by_force(damaged_by_force(rows))
    got = {r[0]: tuple(r)[1:] for r in queries.op12_survivor_viterbi(spark, SF).collect()}
    assert got == {k: v[:8] for k, v in want.items()}


def odd_rows():
    rnd = random.Random(3)
    texts = ["a.", "b", " ", "", None, "\n\t", "x. ", "é!", "end. ", "x" * 100_000 + ".", "a."]
    roles = ["system", "user", "assistant", None, "", "user"]
    ids = [None, *range(40)]
    return [(rnd.choice(ids), rnd.choice([None, *range(-2, 6)]), rnd.choice(roles), rnd.choice(texts)) for _ in range(300)]


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = odd_rows()
    table = spark.createDataFrame(
        [(*r, "f", True) for r in rows], SCHEMA + ", fault string, gone boolean"
    ).repartition(5)
    damaged = repair.damaged(table)
    found = repair.audits(damaged)
    want = audits_by_force(damaged_by_force(rows))
    got = {r.conv_id: r for r in found.collect()}
    assert {k: (*tuple(r)[1:8], r.repaired_sha256) for k, r in got.items()} == {k: v[:8] for k, v in want.items()}
    turns = defaultdict(list)
    for r in sorted(repair.repaired(damaged, found).collect(), key=lambda r: r.position):
        turns[r.conv_id].append((r.role, r.text))
    assert dict(turns) == {k: v[8] for k, v in want.items() if v[8]}


def test_a_conversation_without_rows_left_and_an_empty_table(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(gone, 0, "user", "a.")], SCHEMA)
    (row,) = repair.audits(repair.damaged(table)).collect()
    assert tuple(row)[:9] == (gone, 0, 0, 0, 0, 0, 0, "", "")
    assert row.repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert repair.audits(repair.damaged(table.limit(0))).collect() == []
    assert repair.audits(repair.as_given(table)).first().audit == "KI"
