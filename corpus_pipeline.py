"""The training-data pipeline: filter, deduplicate, sanitise and pack a corpus.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and
returns a DataFrame; all but the last return the columns of ``documents``.  ``run``
writes each stage's result as Parquet under the shared checkpoint folder and rereads it,
so a stage survives lost executors and starts from files.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import lines, omh, packing, pii, toxicity
from strata.llm.common import scratch, table

TOKENIZER = "byte_bpe_50k.json"


def with_text(docs: DataFrame, done: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` from ``done``, with the new text and its length."""
    new = {"text": F.col(text), "n_chars": F.char_length(text).cast("long")}
    return done.select(*(new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier doesn't reject."""
    return toxicity.reject(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that repeat an earlier three-line window."""
    return with_text(docs, lines.deduplicate(docs), "kept_text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each class of near-duplicates, one row for each of its
    different texts; rows with a null id stay."""
    classes = omh.near_duplicates(docs)
    kept = docs.join(classes.where("doc_id <> class_id").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")  # no column meets those added here
    once = kept.where("doc_id IS NOT NULL").select(row, "doc_id", digest.alias("digest")).dropDuplicates(["doc_id", "digest"])
    return kept.where("doc_id IS NULL").unionByName(once.select("row.*"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without personal data and the terms that disclose it."""
    return with_text(docs, pii.sanitise(docs), "text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("pii", sanitise),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


# Compression distance, alignment and packing aren't expressible in SQL.
ORACLE_SQL: str | None = None
