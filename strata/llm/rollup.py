"""Token counts as delta-maintained rollups.

A batch is a set of signed changes (+1 adds a document's count, -1 takes it back; a
revision is both).  Committing reduces it to one additive row per (source, language,
tokenizer version), writes that to a draft folder and gives it the batch's name with the next
generation, by one rename: of a batch only the last generation counts.  So committing a batch
again, with other changes, with none, or after a failure in the middle, leaves the totals
of its last commit.  Totals are sums over the ledger, whose size grows
with batches and groups, never with documents.

Null sources and languages form groups of their own.  Changes with a null sign or
count add nothing; an empty batch leaves the totals as they are.  Groups whose
documents and tokens all cancelled out are left out of the totals.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe
from strata.llm.common import scratch_path
from strata.session import Folder

KEYS = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, documents long, tokens long, batch_id string"


def count_tokens(docs: DataFrame, paths: dict[str, str]) -> DataFrame:
    """(doc_id, source, lang, tokenizer, tokens): every document's id count under
    each tokenizer version.  A null text has 0 tokens."""

    def count(batches):
        for part in bpe.slices(batches):
            texts = part.column(3).to_pylist()
            for version, path in paths.items():
                tokenizer = bpe.load(path)
                tokens = [len(tokenizer.id_bytes(t)) // 4 for t in texts]
                columns = [*part.columns[:3], pa.array([version] * len(tokens)), pa.array(tokens, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "source", "lang", "tokenizer", "tokens"])

    source = docs.select("doc_id", "source", "lang", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[:3])
    return source.mapInArrow(count, f"{fields}, tokenizer string, tokens long")


def inserted(counts: DataFrame) -> DataFrame:
    return counts.withColumn("sign", F.lit(1))


def deleted(counts: DataFrame) -> DataFrame:
    return counts.withColumn("sign", F.lit(-1))


def revised(before: DataFrame, after: DataFrame) -> DataFrame:
    """The old counts taken back and the new ones added, under any keys."""
    return deleted(before).unionByName(inserted(after))


class Ledger:
    """The committed batches under ``path`` on shared storage: a folder of Parquet files
    ``<batch_id in hex>.<generation>`` per commit."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "ledger")
        self.folder = Folder(spark, self.path)

    def last(self) -> dict[str, str]:
        """The folder that counts, by batch."""
        named = (name for name in self.folder.names() if "." in name and not name.startswith("_"))
        return {name.split(".")[0]: name for name in named}  # names come in order

    def commit(self, batch_id: str, changes: DataFrame) -> None:
        """Write the batch's sums; a batch_id that was committed before is replaced whole."""
        sign = F.coalesce(F.col("sign"), F.lit(0)).cast("long")
        sums = changes.groupBy(*KEYS).agg(
            F.sum(F.when(F.col("tokens").isNotNull(), sign)).alias("documents"),
            F.sum(sign * F.col("tokens")).alias("tokens"),
        )
        rows = sums.select(*KEYS, *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("documents", "tokens")))
        draft, key = f"_draft-{uuid.uuid4().hex[:12]}", batch_id.encode().hex()
        rows.withColumn("batch_id", F.lit(batch_id)).write.parquet(self.folder / draft)
        while True:
            before = self.last().get(key)
            generation = int(before.split(".")[1]) + 1 if before else 1
            if self.folder.publish(draft, f"{key}.{generation:09d}", keep=True):
                break
        if before:  # no longer counts; a reader that listed it before still finds the last one of its list
            for name in self.folder.names():
                if name.startswith(f"{key}.") and name < before:
                    self.folder.delete(name)

    def batches(self) -> DataFrame:
        paths = [self.folder / name for name in self.last().values()]
        return self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)

    def totals(self, only: Column | None = None) -> DataFrame:
        """(source, lang, tokenizer, documents, tokens) over all batches, or those that
        ``only`` (a condition on the ledger's columns) selects."""
        rows = self.batches() if only is None else self.batches().where(only)
        sums = rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return sums.where((F.col("documents") != 0) | (F.col("tokens") != 0))
