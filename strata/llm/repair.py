"""Conversation structure repair by Viterbi search with coalescing survivors.

The role initials of a repaired conversation have the form (s?(ua)+)?: nothing, or
user/assistant turns after at most one system turn.  Edits, with their costs: K(eep) 0,
R(erole) 2, D(elete) 3, I(nsert) an empty user or assistant turn 2; a truncated row that
isn't deleted costs 1 more, a blank or repeated one has to be deleted.  The cheapest
edits win, of equally cheap ones the least by their initials (the audit).

Rows stream through in the order of their turns.  Each state of the form (nothing yet,
after s, after u, after a) keeps one survivor: a leaf in a tree of backpointers, with its
cost.  A leaf that no survivor continues is dropped with all that only it
used (reference counts), and what all survivors share is emitted, so the tree holds the
unresolved edits alone.  Survivors that tie are told apart by their whole unresolved
suffixes; none can be the beginning of another (both end in an edit that used up the same
row), so their order, once found, stays, and is kept as a rank beside each survivor instead of
walking back.  A survivor that costs more than another one and whatever a change of
state could cost can't win any more and goes, else "nothing yet" would never coalesce.

Every survivor carries a running digest of the rows it kept, so no text is held back.
Rows of a conversation meet in one task, sorted, since the digest of the whole is made in
order; they are streamed and never held, whatever their number.

Rows are ordered by turn (null first), then role and text; a null role or text is one
space.  Nulls make a conversation of their own.  A repeated row is a duplicate.  Conversations
all of whose rows are dropped come with zeros.  An empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

START, SYSTEM, USER, ASSISTANT = range(4)
# What each state may be followed by, and the edits' costs.
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ADDED = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# MIMIC[s][t]: what it costs at most to continue from s as from t.
MIMIC = {
    START: {SYSTEM: 0, USER: 2, ASSISTANT: 0},
    SYSTEM: {START: 4, USER: 2, ASSISTANT: 4},
    USER: {START: 5, SYSTEM: 2, ASSISTANT: 2},
    ASSISTANT: {START: 3, SYSTEM: 0, USER: 2},
}
LEGAL = {"su", "ua", "au"}
BLANKS = " \t\n\x0b\f\r"
RESULT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, roles string, repaired_sha256 string"
)


@lru_cache(maxsize=None)
def moves(initial: str, delete: bool, truncated: bool) -> tuple[tuple[int, int, int, str, str], ...]:
    """The cheapest ways (of equal ones the least) over one row: (state, new state, cost, edits, roles).
    ``roles`` has the initial of the turn that each edit leaves, '-' where it leaves none."""
    best: dict[tuple[int, int], tuple[int, str, str]] = {}
    for state in NEXT:
        at, before = state, ""
        for inserts in range(3):
            cost, edits = INSERT * inserts, "I" * inserts
            ways = [(at, cost + DELETE, edits + "D", before + "-")]
            if not delete:
                worse = TRUNCATED * truncated
                if initial in NEXT[at]:
                    ways.append((NEXT[at][initial], cost + worse, edits + "K", before + initial))
                role = ADDED[at][0]
                ways.append((NEXT[at][role], cost + REROLE + worse, edits + "R", before + role))
            for to, *way in ways:
                best[state, to] = min(best.get((state, to), tuple(way)), tuple(way))
            before += ADDED[at][0]
            at = NEXT[at][ADDED[at][0]]
    return tuple((a, b, *way) for (a, b), way in sorted(best.items()))


class Node:
    """Edits on the way to a survivor, after those of ``parent``."""

    __slots__ = ("parent", "edits", "roles", "kids")

    def __init__(self, parent: Node | None, edits: str, roles: str):
        self.parent, self.edits, self.roles, self.kids = parent, edits, roles, []

    def release(self) -> None:
        """Drop this leaf, and every ancestor that only it refers to."""
        node = self
        while node.parent is not None and not node.kids:
            node.parent.kids.remove(node)
            node.parent, node = None, node.parent


class Repair:
    """The search over one conversation: ``push`` its rows, then ``finish``."""

    def __init__(self) -> None:
        self.root = Node(None, "", "")
        self.cost = 0
        self.survivors = {START: (0, 0, self.root, hashlib.sha256(), False)}  # cost, rank, leaf, digest, has a turn
        self.edits: list[str] = []
        self.roles: list[str] = []

    def push(self, role: str, text: str, delete: bool, truncated: bool) -> None:
        found: dict[int, tuple] = {}
        for state, to, cost, edits, roles in moves(role[:1], delete, truncated):
            if state in self.survivors:
                old = self.survivors[state]
                way = (old[0] + cost, old[1], edits, state, roles)
                if to not in found or way < found[to]:
                    found[to] = way
        cheap = {s: w[0] for s, w in found.items()}
        found = {s: w for s, w in found.items() if all(w[0] <= cheap[t] + MIMIC[t][s] for t in cheap if t != s)}
        order = {s: k for k, s in enumerate(sorted(found, key=lambda s: found[s][1:3]))}
        leaves = [self.survivors[s][2] for s in self.survivors]
        put = f"{text}".encode()
        new = {}
        for to, (cost, _, edits, state, roles) in found.items():
            _, _, leaf, digest, some = self.survivors[state]
            node = Node(leaf, edits, roles)
            leaf.kids.append(node)
            if edits != "D":
                digest = digest.copy()
                at = state
                for edit in edits:
                    if edit == "D":
                        continue
                    name = role if edit == "K" else ADDED[at]
                    digest.update((b"\n" if some else b"") + name.encode() + b":" + (b"" if edit == "I" else put))
                    some, at = True, NEXT[at][name[0]]
            new[to] = (cost, order[to], node, digest, some)
        self.survivors = new
        for leaf in leaves:
            if not leaf.kids:
                leaf.release()
        self.emit()

    def emit(self) -> None:
        """Move what all survivors share from the tree to the result."""
        while len(self.root.kids) == 1:
            (node,) = self.root.kids
            node.parent, self.root = None, node
            self.edits.append(node.edits)
            self.roles.append(node.roles)

    def finish(self) -> tuple[int, str, str, str]:
        """Cost, audit, role initials by edit ('-': none) and digest of the repaired rows."""
        ends = []
        for state, (cost, rank, node, digest, some) in self.survivors.items():
            inserts = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[state]
            ends.append((cost + INSERT * inserts, rank, "I" * inserts, state, node, digest, some))
        cost, _, tail, at, node, digest, some = min(ends, key=lambda e: e[:3])
        edits, roles, digest = [], [], digest.copy()
        while node is not self.root:
            edits.append(node.edits)
            roles.append(node.roles)
            node = node.parent
        after = ""
        for _ in tail:
            digest.update((b"\n" if some else b"") + ADDED[at].encode() + b":")
            after, some, at = after + ADDED[at][0], True, NEXT[at][ADDED[at][0]]
        audit = "".join([*self.edits, *reversed(edits), tail])
        return cost, audit, "".join([*self.roles, *reversed(roles), after]), digest.hexdigest()


class Conversation:
    """One conversation's counts and repair, over its rows in order."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.search = conv_id, Repair()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.before = None

    def push(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if turn is not None:
            self.turns += turn != self.last
            self.first, self.last = turn if self.first is None else self.first, turn
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        if self.before is not None:
            self.illegal += self.before + role[:1] not in LEGAL
        self.before = role[:1]
        self.search.push(role, text, fault in ("blank", "duplicate"), fault == "truncated")

    def result(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.search.finish())


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows damaged by crc32("conv_id:turn") % 20, a null
    in it written as one space: 0 drops the row (it stays here as ``gone``), 1 empties its
    text, 2 removes its ends of sentences, 3 repeats it, 4 makes it the user's."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hurt = F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), hurt.alias("hurt"))
    text = F.when(F.col("hurt").isin(0, 1), "").when(F.col("hurt") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("hurt") == 3, 2).otherwise(1)))
    rows = rows.select(
        "conv_id",
        "turn",
        F.when(F.col("hurt") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("hurt") == 0).alias("gone"),
        times.alias("time"),
    )
    return rows.drop("time")


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` with the first fault of each: blank, duplicate, truncated or none.  Dealt by
    conversation once; the window over equal rows needs no further shuffle."""
    dealt = rows.repartition("conv_id").withColumn("digest", F.md5(F.col("text").cast("binary")))
    equal = Window.partitionBy("conv_id", "gone", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    trimmed = F.rtrim("text", F.lit(BLANKS))
    fault = (
        F.when(trimmed == "", "blank")
        .when(F.row_number().over(equal) > 1, "duplicate")
        .when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    return dealt.withColumn("fault", fault).drop("digest")


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation: its id and RESULT.  ``rows`` has conv_id, turn, role, text
    and gone; rows that are gone only name their conversation."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    ordered = with_faults(rows).sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"
    )
    names = ["conv_id", *(f.split()[0] for f in RESULT.split(", "))]
    if rows.schema["turn"].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError("turns are whole numbers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.null(), *([pa.int64()] * 6), *([pa.string()] * 3)]

        def batch(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)

        done, size, open_ = [], 0, None
        for part in batches:
            types[0] = part.schema.field(0).type
            for conv_id, turn, role, text, gone, fault in zip(*(c.to_pylist() for c in part.columns)):
                if open_ is None or open_.conv_id != conv_id:
                    if open_ is not None:
                        done.append(open_.result())
                        size += len(done[-1][7])
                        if len(done) >= 5_000 or size > 1 << 22:
                            yield batch(done)
                            done, size = [], 0
                    open_ = Conversation(conv_id)
                if not gone:
                    open_.push(turn, role, text, fault)
        if open_ is not None:
            yield batch([*done, open_.result()])

    return ordered.select("conv_id", "turn", "role", "text", "gone", "fault").mapInArrow(run, f"conv_id {kind}, {RESULT}")


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (without those gone) with their place in the conversation, from 1."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.where(~F.col("gone")).withColumn("place", F.row_number().over(order))


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, position, edit, role, text): the turns of the repaired conversations, as
    the audits ``found`` say.  Each edit but an insertion uses up the next row."""
    pairs = F.zip_with(F.split("audit", ""), F.split("roles", ""), lambda e, r: F.struct(e.alias("edit"), r.alias("initial")))
    edits = found.select(F.col("conv_id").alias("conv"), F.posexplode(pairs).alias("at", "e"))
    edits = edits.select("conv", "at", "e.edit", "e.initial").where("edit <> ''")
    so_far = Window.partitionBy("conv").orderBy("at")
    edits = edits.select(
        "conv",
        "edit",
        "initial",
        F.sum((F.col("edit") != "I").cast("int")).over(so_far).alias("used"),
        F.sum((F.col("edit") != "D").cast("int")).over(so_far).alias("position"),
    ).where("edit <> 'D'")
    used = F.when(F.col("edit") != "I", F.col("used"))
    same = F.col("conv").eqNullSafe(F.col("conv_id")) & (used == F.col("place"))
    named = F.when(F.col("edit") == "K", F.col("role")).when(F.col("initial") == "u", "user").otherwise("assistant")
    return edits.join(numbered(rows), same, "left").select(
        F.col("conv").alias("conv_id"), "position", "edit", named.alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )


def as_given(conversations: DataFrame) -> DataFrame:
    """``conversations`` as rows to repair, without any damage."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return conversations.select("conv_id", "turn", space("role"), space("text"), F.lit(False).alias("gone"))
