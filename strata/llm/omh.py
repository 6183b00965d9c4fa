"""Near-duplicate documents by order MinHash, verified by banded alignment.

A document is its sequence of five-word shingles (white space splits words; a text of
fewer than five words is one shingle).  A sketch takes the LENGTH smallest of the
occurrence-labelled shingle hashes and keeps them in text order, so two documents agree
on it when they share shingles *in the same order*, as similar edits leave them.
SKETCHES such keys make the candidate buckets; short documents also get keys of one
shingle each, as few shingles leave little to sample from.

Candidates are verified by an alignment of their shingle sequences: with m shingles in
common order, similarity is m / (a + b - m), at least SIMILARITY.  That bounds the
edits to (a + b)(1 - s)/(1 + s), which is the band that the alignment searches.

Equal texts (after white space) form one class at once and are sketched as one.  In a
bucket every text is compared with the bucket's first one (smallest id), not with all;
texts that this leaves outside the bucket's largest class are compared with the text of
that class nearest to the first one, again one pair each.  Texts that are still
in another class than a bucket mate are then compared with such mates as the distances to that first text (the triangle inequality of the edit distance)
and the parity bits of their shingles allow.  Both are bounds, so no link between bucket
mates is lost, and copies aren't expanded into pairs.  Linked texts form classes by alternating large and small stars.

Two documents of similarity 0.8 share a bucket with probability 1 - (1 - C(0.8 u, 6) /
C(u, 6))^24 for u different shingles in both: 0.996 at u = 20, 0.9987 at 50, over 0.999
from about 90 on; closer ones more surely.  Null and empty texts are one class of equal
texts.  Rows that share a doc_id come once, with the smallest class of their texts.  Null
doc_ids are left out.  An empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.bpe import slices
from strata.llm.common import ids_and_texts, scratch

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES, LENGTH = 24, 6
BITS = 2  # parity bits of a text by its shingles, at least
SHORT, LONG = 15, 8  # single-shingle keys up to SHORT shingles, ordered ones from LONG on
MEMO_WORDS = 100_000

_RNG = np.random.default_rng(20)
_FACTORS = _RNG.integers(1, 2**63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_U = np.uint64(0x632BE59BD9B4E019)
_ADDENDS = _RNG.integers(0, 2**63, SKETCHES, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class _Words(dict):
    """A bounded memo of word hashes."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingle_hashes(words: list[str], memo) -> np.ndarray:
    """Hashes of the shingles, each labelled with its occurrence number."""
    w = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE, len(w))
    h = np.zeros(len(w) - size + 1, np.uint64) if size else np.zeros(0, np.uint64)
    for i in range(size):
        h = _mix(h * np.uint64(31) + w[i : len(w) - size + 1 + i])
    order = np.argsort(h, kind="stable")
    same = np.concatenate([[False], h[order][1:] == h[order][:-1]]) if len(h) else np.zeros(0, bool)
    if same.any():
        at = np.arange(len(h))
        number = np.empty(len(h), np.uint64)
        number[order] = at - np.maximum.accumulate(np.where(same, 0, at))
        h = np.where(number > 0, _mix(h + number * np.uint64(0xD1B54A32D192ED03)), h)
    return h


def sketch_keys(h: np.ndarray) -> np.ndarray:
    """The bucket keys of a document's labelled shingle hashes."""
    if not len(h):
        return np.zeros(0, np.int64)
    values = _mix(h[None, :] * _FACTORS[:, None] + _ADDENDS[:, None])
    seeds = np.arange(SKETCHES, dtype=np.uint64)
    keys = []
    if len(h) <= SHORT:
        keys.append(_mix(_mix(h[values.argmin(axis=1)] + np.uint64(7)) * np.uint64(31) + seeds))
    if len(h) >= LONG:
        least = np.sort(np.argpartition(values, LENGTH - 1, axis=1)[:, :LENGTH], axis=1)  # in text order
        key = _mix(seeds + np.uint64(1000))
        for i in range(LENGTH):
            key = _mix(key * np.uint64(31) + h[least[:, i]])
        keys.append(key)
    return np.concatenate(keys).view(np.int64)


def parity_bits(h: np.ndarray) -> np.ndarray:
    """For every residue of the shingle hashes whether an odd number of them has it, a
    power of two residues, BITS for each shingle or up to twice as many."""
    size = max(64, 1 << (BITS * len(h) - 1).bit_length())
    residue = ((_mix(h + _U) >> np.uint64(32)) & np.uint64(size - 1)).astype(np.int64)
    odd = (np.bincount(residue, minlength=size) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def digest(words: list[str]) -> bytes:
    return hashlib.blake2b("\n".join(words).encode("utf-8"), digest_size=16).digest()


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, same, n, keys, bits): a digest of the words, the number of shingles, the
    bucket keys and the parity bits of every row.  A narrow map."""

    def compute(batches):
        memo = _Words()
        for part in slices(batches):
            digests, sizes, keys, bits = [], [], [], []
            for text in part.column(1).to_pylist():
                words = text.split()
                h = shingle_hashes(words, memo)
                digests.append(digest(words))
                sizes.append(len(h))
                keys.append(sketch_keys(h))
                bits.append(parity_bits(h))
            columns = [part.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64())]
            for lists in (keys, bits):
                ends = np.cumsum([0, *map(len, lists)])
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(lists))))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "same", "n", "keys", "bits"])

    source = ids_and_texts(docs).where(F.col("doc_id").isNotNull())
    key = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(compute, f"doc_id {key}, same binary, n long, keys array<long>, bits array<long>")


def with_digests(source: DataFrame) -> DataFrame:
    """``source`` (doc_id, text) with the digest ``same`` of the words, as ``sketch`` has it."""

    def compute(batches):
        for part in slices(batches):
            digests = [digest(text.split()) for text in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(digests, pa.binary())], ["doc_id", "text", "same"])

    key = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(compute, f"doc_id {key}, text string, same binary")


def may_be_similar(a: str, b: str) -> Column:
    """Whether two texts (prefixes of their columns n and bits) can reach SIMILARITY.

    Each shingle that only one of them has changes one of its parity bits, so the bits
    that differ are no more than the edits between them: a bound, not an estimate.  Of
    lengths that allow it, one has at most twice the other's bits, which fold to those."""
    n, m, x, y = F.col(f"{a}n"), F.col(f"{b}n"), F.col(f"{a}bits"), F.col(f"{b}bits")

    def folded(own: Column, other: Column) -> Column:
        half = F.size(other)
        return F.when(F.size(own) <= half, own).otherwise(F.transform(other, lambda _, i: F.get(own, i).bitwiseXOR(F.get(own, i + half))))

    apart = F.zip_with(folded(x, y), folded(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    apart = F.aggregate(apart, F.lit(0), lambda total, one: total + one)
    return (F.least(n, m) >= SIMILARITY * F.greatest(n, m) - 1e-9) & (apart <= allowed_edits(n, m))


def allowed_edits(n: Column, m: Column) -> Column:
    """``most_edits`` as a column."""
    return F.floor((n + m) * ((1 - SIMILARITY) / (1 + SIMILARITY)) + 1e-9)


def aligned_edits(a: list, b: list, limit: int) -> int:
    """Insertions and deletions that turn ``a`` into ``b`` if at most ``limit``, else
    limit + 1.  Searches the diagonals of the band alone, furthest paths first."""
    start, n = 0, min(len(a), len(b))
    while start < n and a[start] == b[start]:
        start += 1
    end = 0
    while end < n - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return limit + 1
    reach = {1: 0}
    for edits in range(min(limit, n + m) + 1):
        for k in range(-edits, edits + 1, 2):
            if k == -edits or (k != edits and reach[k - 1] < reach[k + 1]):
                x = reach[k + 1]
            else:
                x = reach[k - 1] + 1
            y = x - k
            while x < n and y < m and a[x] == b[y]:
                x += 1
                y += 1
            reach[k] = x
            if x >= n and y >= m:
                return edits
    return limit + 1


def most_edits(a: int, b: int, similarity: float = SIMILARITY) -> int:
    """The most edits that leave sequences of these lengths similar enough."""
    return int((a + b) * (1 - similarity) / (1 + similarity) + 1e-9)


def shingles(text: str) -> list[tuple]:
    words = text.split()
    return list(zip(*(words[i:] for i in range(SHINGLE)))) if len(words) >= SHINGLE else [tuple(words)]


def edits_between(a: list, b: list, limit: int) -> int:
    """``aligned_edits``, unless the shingles in common already rule the pair out."""
    common = sum((Counter(a) & Counter(b)).values())
    bound = len(a) + len(b) - 2 * common
    return bound if bound > limit else aligned_edits(a, b, limit)


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with ``edits`` (a lower bound where it is over what similarity
    allows) and whether they are ``similar``."""

    def compute(batches):
        for part in slices(batches, 64):
            edits, similar = [], []
            for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                x, y = shingles(x), shingles(y)
                limit = most_edits(len(x), len(y))
                edits.append(edits_between(x, y, limit))
                similar.append(edits[-1] <= limit)
            columns = [part.column(0), part.column(1), pa.array(edits, pa.int64()), pa.array(similar)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "edits", "similar"])

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    key = pairs.schema["a"].dataType.simpleString()
    return joined.mapInArrow(compute, f"a {key}, b {key}, edits long, similar boolean")


def classes_of_links(links: DataFrame) -> DataFrame:
    """(doc_id, root) of all linked documents but the roots themselves: the smallest id
    that links lead to.  Ends as soon as the links are stars, which the neighbours of
    each document tell that the next round needs anyway."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = scratch(edges.where("u <> v").distinct(), "edges")
    while True:
        both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        below, above = (F.count_if(c).alias(n) for c, n in ((F.col("v") < F.col("u"), "below"), (F.col("v") > F.col("u"), "above")))
        around = scratch(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), below, above), "around")
        if around.where("below > 1 OR (below = 1 AND above > 0)").isEmpty():
            return edges.select(F.col("u").alias("doc_id"), F.col("v").alias("root"))
        large = both.join(around.select("u", "m"), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch(large.where("u <> v").distinct(), "large")
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = small.select(F.inline(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))))
        edges = scratch(small.where("u <> v").distinct(), "edges")


def joined_classes(root: DataFrame, links: DataFrame) -> DataFrame:
    """``root`` (as ``classes_of_links`` gives it) after more ``links``: these link whole
    classes, so the steps go over the roots they meet and not over all links again."""
    for end in ("a", "b"):
        found = root.select(F.col("doc_id").alias(end), "root")
        links = links.join(found, end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
    above = classes_of_links(links).select(F.col("doc_id").alias("root"), F.col("root").alias("top"))
    moved = root.join(above, "root", "left").select("doc_id", F.coalesce("top", "root").alias("root"))
    return scratch(moved.unionByName(above.select(F.col("root").alias("doc_id"), F.col("top").alias("root"))), "root")


def with_roots(mates: DataFrame, root: DataFrame) -> DataFrame:
    """``mates`` (key, b, ...) with the class of each as linked so far."""
    placed = mates.join(root.withColumnRenamed("doc_id", "b"), "b", "left")
    return placed.withColumn("root", F.coalesce("root", "b"))


def new_pairs(found: DataFrame, compared: DataFrame) -> DataFrame:
    """(a, b) of ``found`` (b, o_b) in order, once, without those already compared."""
    pairs = found.select(F.least("b", "o_b").alias("a"), F.greatest("b", "o_b").alias("b")).distinct()
    return pairs.join(compared.select("a", "b"), ["a", "b"], "left_anti")


def to_central(placed: DataFrame) -> DataFrame:
    """(b, o_b): every text with the central one of its bucket's largest class, if that isn't
    its own class; a row for each of the bucket at most.  Central is the text of the
    fewest edits to the bucket's first one: where copies differ each by edits of its own,
    it has the fewest of these."""
    others = placed.where("a <> b")
    central = F.min(F.struct(~F.col("similar"), "edits", "b", "n", "bits")).alias("o")
    classes = others.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"), central)
    largest = classes.groupBy("key").agg(F.max(F.struct("size", "root", "o")).alias("most"))
    largest = largest.select("key", F.col("most.root").alias("o_root"), *(F.col(f"most.o.{c}").alias(f"o_{c}") for c in ("b", "n", "bits")))
    return others.join(largest, "key").where((F.col("root") != F.col("o_root")) & may_be_similar("", "o_")).select("b", "o_b")


def between_mates(placed: DataFrame) -> DataFrame:
    """(b, o_b): all bucket mates of different classes that may be similar; one of them
    isn't similar to the bucket's first text."""
    outside = placed.where(~F.col("similar")).select("key", *(F.col(c).alias(f"o_{c}") for c in ("b", "n", "bits", "edits", "root")))
    # Edits to the bucket's first text bound those between two of its texts: exact ones
    # from both sides, the lower bounds of texts that aren't similar to it from one.
    allowed = allowed_edits(F.col("n"), F.col("o_n"))
    near = may_be_similar("", "o_") & (~F.col("similar") | (F.col("o_edits") - F.col("edits") <= allowed))
    return outside.join(placed.where("a <> b"), "key").where((F.col("root") != F.col("o_root")) & near).select("b", "o_b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id): every document and the smallest id of its class."""
    # Within, a document is its doc_id and its text's digest: rows may share a doc_id.
    named = F.struct("doc_id", "same").alias("doc_id")
    rows = scratch(sketch(docs), "sketches").select(named, "same", "n", "keys", "bits")
    equal = scratch(rows.groupBy("same").agg(F.min("doc_id").alias("first")), "equal")
    heads = rows.join(equal.select(F.col("first").alias("doc_id")), "doc_id", "left_semi")
    members = scratch(heads.dropDuplicates(["doc_id"]).select("doc_id", "n", F.explode("keys").alias("key")), "members")

    buckets = members.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a <> z")
    buckets = scratch(buckets.select("key", "a"), "buckets")
    held = scratch(members.join(buckets, "key").select("key", "a", F.col("doc_id").alias("b"), "n"), "held")
    pairs = held.where("a <> b").select("a", "b").distinct()
    wanted = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))
    wanted = scratch(wanted.distinct(), "wanted")
    # Written first, as texts stay where they are while Spark may broadcast the ids.
    asked = scratch(wanted.select("doc_id.doc_id").distinct(), "asked")
    texts = ids_and_texts(docs).join(asked, "doc_id", "left_semi").select("doc_id", "text")
    texts = scratch(with_digests(texts).select(named, "text").join(wanted, "doc_id").dropDuplicates(["doc_id"]), "texts")
    compared = scratch(verify(pairs, texts), "compared")
    root = classes_of_links(compared.where("similar").select("a", "b"))
    placed = held.join(compared.select("a", "b", "edits", "similar"), ["a", "b"], "left")
    bits = rows.select(F.col("doc_id").alias("b"), "bits").join(wanted.withColumnRenamed("doc_id", "b"), "b").dropDuplicates(["b"])
    mates = scratch(placed.join(bits, "b"), "mates")
    placed = scratch(with_roots(mates, root), "placed")

    # Most texts that the first one leaves out are near another of its class: one pair each.
    pairs = new_pairs(to_central(placed), compared)
    near = scratch(verify(scratch(pairs, "central"), texts), "near")
    found = near.where("similar").select("a", "b")
    if not found.isEmpty():
        root = joined_classes(root, found)
        placed = scratch(with_roots(mates, root), "placed")

    pairs = new_pairs(between_mates(placed), compared.unionByName(near))
    found = scratch(verify(scratch(pairs, "more"), texts).where("similar").select("a", "b"), "found")
    if not found.isEmpty():
        root = joined_classes(root, found)

    known = rows.select("doc_id", "same").join(equal.select("same", "first"), "same")
    joined = known.join(root.withColumnRenamed("doc_id", "first"), "first", "left")
    least = joined.groupBy(F.col("doc_id.doc_id").alias("doc_id")).agg(F.min(F.coalesce("root", "first")).alias("class_"))
    return least.select("doc_id", F.col("class_.doc_id").alias("class_id"))
