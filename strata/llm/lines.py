"""Line deduplication by overlapping three-line windows, DataFrame functions only.

Each run of three consecutive lines is a window, hashed to 128 bits.  The first
window of a kind over the corpus, by (doc_id, number of its line), stays; every later
one covers its three lines, overlapping covers merge, and covered lines go.

Lines are split at line feeds and compared as they are.  Windows of blank lines alone
are none.  A covered line goes also where the first window of its kind holds it too.  Documents of fewer than three lines have no window and stay whole.  A null
text has no line and stays null.  Rows that share a doc_id are told apart by their
text; rows equal in both count as one occurrence.  Null doc_ids come first.

Scale: the windows shuffle as 16-byte keys, never the lines; windows that occur once
drop out in a map-side aggregate and its merge; the join that finds the later ones is
an ordinary one that adaptive execution can split at a hot window; the covered
positions join the documents by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import scratch

WINDOW = 3


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """(k1, k2, doc_id, copy, line): every window's key, its document and first line.

    ``copy`` is a hash of the text, which tells rows of one doc_id apart."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("copy"), split_lines(F.col("text")).alias("lines"))
    hashed = lines.where(F.size("lines") >= size).select(
        "doc_id",
        "copy",
        F.transform("lines", lambda x: F.xxhash64(x)).alias("a"),
        F.transform("lines", lambda x: F.xxhash64(F.lit(1), x)).alias("b"),
        F.transform("lines", lambda x: F.trim(x) != "").alias("ink"),
    )

    def window(i: Column) -> Column:
        at = [i + n for n in range(size)]
        ink = F.get("ink", at[0])
        for n in at[1:]:
            ink |= F.get("ink", n)
        a, b = ([F.get(c, n) for n in at] for c in ("a", "b"))
        return F.struct(F.xxhash64(*a).alias("k1"), F.xxhash64(F.lit(2), *b).alias("k2"), ink.alias("ink"))

    found = F.transform(F.sequence(F.lit(0), F.size("a") - size), window)
    rows = hashed.select("doc_id", "copy", F.posexplode(found).alias("line", "w")).where("w.ink")
    return rows.select("w.k1", "w.k2", "doc_id", "copy", "line")


def covered_lines(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, copy, covered): the sorted line numbers that later windows cover, for
    documents that have any."""
    found = windows(docs, size)
    place = F.struct("doc_id", "copy", "line")
    repeated = (
        found.groupBy("k1", "k2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where(~F.col("first").eqNullSafe(F.col("last")))
        .select("k1", "k2", "first")
    )
    later = found.join(scratch(repeated, "windows"), ["k1", "k2"]).where(~place.eqNullSafe(F.col("first")))
    starts = later.groupBy("doc_id", "copy").agg(F.collect_set("line").alias("starts"))
    every = F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (size - 1))))
    return starts.select("doc_id", "copy", F.array_sort(F.array_distinct(every)).alias("covered"))


def deduplicate(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` (doc_id, text, ...) with n_lines, n_removed and ``kept_text``: the
    text without the lines that repeat an earlier window.  All rows stay; a text that
    loses every line becomes empty.  The columns of ``docs`` stay as they are; one of
    its own named like an added column is replaced."""
    added = ["n_lines", "n_removed", "kept_text"]
    own = [c for c in docs.columns if c not in added]
    found = covered_lines(docs.select("doc_id", "text"), size).withColumnRenamed("doc_id", "id")
    rows = docs.select(F.struct(*own).alias("row"), "doc_id", "text", F.xxhash64("text").alias("key"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("copy")), "left")
    joined = joined.withColumn("lines", split_lines(F.col("text")))  # a column, as a lambda would split anew
    lines = F.col("lines")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "covered")
    return joined.select(
        *(F.col(f"row.`{c}`").alias(c) for c in own),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("covered").isNull(), F.col("text"))
        .otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
        .alias("kept_text"),
    )
