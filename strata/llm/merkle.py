"""A Merkle manifest of a corpus, and every document's proof, by nested-struct rollup.

Every row is a leaf.  The leaves of a source, in the order of their ids, are hashed in runs of
FAN until one node, the subroot, is left; the subroots, in the order of their sources,
likewise give the root.

The rank of a node, written to the base FAN, says under which parents it comes.  A tier takes
DEPTH levels at once: nodes are dealt by source and block (FAN ** DEPTH ranks), and
within a block the digits are grouped away one after the other, each parent holding its
children as an array of structs, so that a block's whole subtree stands in one row of
bounded size.  The blocks' nodes are the next tier's leaves.  On the way down a block's row is
given the siblings above it, and transform and explode alone hand them, with those inside the
block, to its leaves: one row per block is joined, none per leaf.

Ranks come from one sort by range: a row's number within its part, and the rows of its
source in the parts before.  No source, however large, meets in one task; equal rows
are told apart by their place in the table, so they can be dealt to several parts too.

Null fields are written "-".  Null ids come first, rows of one id by their leaf; repeated
rows are leaves each.  Null sources make a source of their own, the first.  Very long
texts are hashed where they are read and never shuffled.  An empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import scratch

FAN, DEPTH = 16, 3
BLOCK = FAN**DEPTH
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIDES = "array<struct<left: string, right: string>>"


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def leaf_of(text: Column | None = None) -> Column:
    """The digest of a row's fields, with another text if one is given."""

    def written(c: str) -> Column:
        value = text if c == "text" and text is not None else F.col(c).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return digest(F.concat(*map(written, FIELDS)))


def tampered() -> Column:
    """The leaf after tampering (A-Z of the text in lower case), null where it is left alone:
    all rows but those whose crc32 of the id is divided by 5."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return F.when(hit, leaf_of(F.translate(F.col("text").cast("string"), _UPPER, _UPPER.lower())))


def leaves(docs: DataFrame) -> DataFrame:
    """(key, doc_id, hash, changed): every row's leaf under its source's key, which sorts
    as the sources do, null first."""
    key = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
    return scratch(docs.select(key.alias("key"), "doc_id", leaf_of().alias("hash"), tampered().alias("changed")), "leaves")


def ranked(nodes: DataFrame, order: list[Column]) -> DataFrame:
    """``nodes`` (written ones, with a key) with their rank, from 0, within the key, and
    n, the number of the key's nodes."""
    columns = nodes.columns
    by = [F.col("key"), *order, F.col("_row")]
    sorted_ = nodes.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    # A row's number: its part in the upper bits, its place there in the lower ones.
    numbered = scratch(sorted_.select(*columns, F.monotonically_increasing_id().alias("_at")), "sorted")
    part = F.shiftrightunsigned("_at", 33).alias("_part")
    parts = numbered.groupBy("key", part).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy("key").orderBy("_part")) - F.col("_rows")
    parts = parts.select("key", "_part", (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(Window.partitionBy("key")).alias("n"))
    placed = numbered.withColumn("_part", part).join(scratch(parts, "parts"), ["key", "_part"])
    return placed.select(*columns, (F.col("_at") + F.col("_shift")).alias("rank"), "n")


def rollup(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """One tier: (key, n, block, hash, kids), the nodes of each block nested by digit.
    A level hashes as long as its key has several nodes there."""
    digit = lambda level: (F.floor(F.col("rank") / FAN ** (level - 1)) % FAN).cast("int")
    digits = [f"d{level}" for level in range(1, DEPTH + 1)]
    kid = F.struct(F.col("d1").alias("digit"), "hash", F.struct(*payload).alias("held") if payload else F.lit(0).alias("held"))
    up = nodes.select(
        "key",
        "n",
        F.floor(F.col("rank") / BLOCK).alias("block"),
        *(digit(level).alias(name) for level, name in enumerate(digits, 1)),
        "hash",
        *payload,
    ).repartition("key", "block")
    up = up.select("key", "n", "block", *digits[1:], kid.alias("kid"))
    for level in range(1, DEPTH + 1):
        grouped = up.groupBy("key", "n", "block", *digits[level:]).agg(F.array_sort(F.collect_list("kid")).alias("kids"))
        several = F.col("n") > FAN ** (level - 1)
        joined = F.array_join(F.transform("kids", lambda k: k["hash"]), "")
        up = grouped.withColumn("hash", F.when(several, digest(joined)).otherwise(F.col("kids")[0]["hash"]))
        if level < DEPTH:
            kid = F.struct(F.col(digits[level]).alias("digit"), "hash", F.col("kids").alias("held"))
            up = up.select("key", "n", "block", *digits[level + 1 :], kid.alias("kid"))
    return scratch(up.select("key", "n", "block", "hash", "kids"), "blocks")


def tiers(nodes: DataFrame, payload: list[str]) -> list[DataFrame]:
    """The blocks of every tier, up to the one where every key has a single block."""
    blocks = [rollup(nodes, payload)]
    most = blocks[0].agg(F.max("n")).first()[0] or 0
    while most > BLOCK:
        most = -(-most // BLOCK)
        n = F.ceil(F.col("n") / BLOCK).alias("n")
        blocks.append(rollup(blocks[-1].select("key", n, F.col("block").alias("rank"), "hash"), []))
    return blocks


def unrolled(blocks: DataFrame, above: DataFrame, carried: list[str]) -> DataFrame:
    """(key, rank, hash, held, path, carried columns): every node of a tier's blocks with its siblings'
    hashes, left and right of it, level by level.  ``above`` has key, block, the path of
    the block and the carried columns."""
    rows = blocks.drop("hash").join(above, ["key", "block"])
    keep = ["key", "n", *carried]

    def opened(kids: Column, level: int) -> Column:
        hashes = F.transform(kids, lambda k: k["hash"])
        beside = lambda i: F.struct(
            F.array_join(F.slice(hashes, 1, i), "").alias("left"), F.array_join(F.slice(hashes, i + 2, FAN), "").alias("right")
        )
        several = F.col("n") > FAN ** (level - 1)
        none = F.array().cast(SIDES)
        return F.transform(
            kids, lambda k, i: F.struct(k["digit"], k["hash"], k["held"], F.when(several, F.array(beside(i))).otherwise(none).alias("side"))
        )

    rows = rows.select(*keep, F.col("block").alias("rank"), F.col("kids").alias("held"), "path")
    for level in range(DEPTH, 0, -1):
        rows = rows.select(*keep, "rank", "path", F.explode(opened(F.col("held"), level)).alias("k"))
        rows = rows.select(
            *keep,
            (F.col("rank") * FAN + F.col("k.digit")).alias("rank"),
            F.col("k.hash").alias("hash"),
            F.col("k.held").alias("held"),
            F.concat("k.side", "path").alias("path"),
        )
    return rows.drop("n")


def down(blocks: list[DataFrame], above: DataFrame, carried: list[str]) -> DataFrame:
    """The nodes under all tiers, each with its path; ``above`` tells each key's own path."""
    above = above.withColumn("block", F.lit(0).cast("long"))
    for tier in reversed(blocks[1:]):
        rows = unrolled(tier, above, carried)
        above = scratch(rows.select("key", F.col("rank").alias("block"), "path", *carried), "above")
    return unrolled(blocks[0], above, carried)


def manifest(docs: DataFrame) -> DataFrame:
    """Every document's proof: (source_key, doc_id, leaf, changed, subroot, root, path).
    ``path`` lists the siblings' hashes, left and right, from the leaf's run to the root;
    ``changed`` is the leaf after tampering."""
    found = leaves(docs)
    held = ["doc_id", "changed"]
    by_source = tiers(ranked(found, [F.col("doc_id").asc_nulls_first(), F.col("hash"), F.col("changed")]), held)
    subroots = scratch(by_source[-1].select(F.lit("").alias("key"), F.col("key").alias("source_key"), "hash"), "subroots")
    whole = tiers(ranked(subroots, [F.col("source_key")]), ["source_key"])
    root = whole[-1].select("key", F.col("hash").alias("root"), F.array().cast(SIDES).alias("path"))
    sources = down(whole, root, ["root"])
    sources = scratch(sources.select(F.col("held.source_key").alias("key"), F.col("hash").alias("subroot"), "root", "path"), "sources")
    rows = down(by_source, sources, ["subroot", "root"])
    return rows.select(
        F.col("key").alias("source_key"), "held.doc_id", F.col("hash").alias("leaf"), "held.changed", "subroot", "root", "path"
    )


def proof(path: Column) -> Column:
    """The digest of a path's siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda node, p: digest(F.concat(p["left"], node, p["right"])))
