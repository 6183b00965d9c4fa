"""Fitted models that outlive their session: versioned folders on shared storage.

    <path>/v000001/vocabulary, weights, idf   Parquet
    <path>/v000001/manifest                   settings, and rows and checksum of each table

A version is written as a draft and given its number in one step, so one that has a number is
whole; of two writers the later takes the next number.  Loading checks every table
against its checksum (a sum of row hashes, the same in any order and partitioning).
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import logreg, text
from strata.session import Folder

TABLES = ("vocabulary", "weights", "idf")


class Model(NamedTuple):
    version: str
    settings: dict
    vocabulary: DataFrame  # (word, count, pos)
    weights: DataFrame | None  # (pos, weight)
    idf: DataFrame | None  # (pos, idf)


def checksum(table: DataFrame) -> tuple[int, str]:
    """(rows, sum of their hashes): equal for equal rows in any order."""
    hashes = F.xxhash64(*sorted(table.columns)).cast("decimal(38,0)")
    row = table.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(hashes), F.lit(0)).cast("string").alias("sum")).first()
    return row["rows"], row["sum"]


def versions(spark: SparkSession, path: str) -> list[str]:
    return [name for name in Folder(spark, path).names() if name[0] == "v" and name[1:].isdigit()]


def save_model(
    path: str, settings: dict, vocabulary: DataFrame, weights: DataFrame | None = None, idf: DataFrame | None = None
) -> str:
    """Write a new version and return its name.  ``settings`` are plain values."""
    spark = vocabulary.sparkSession
    folder, draft, held = Folder(spark, path), f"_draft-{uuid.uuid4().hex[:12]}", {}
    for name, table in zip(TABLES, (vocabulary, weights, idf)):
        if table is not None:
            table.write.parquet(f"{folder / draft}/{name}")
            written = spark.read.parquet(f"{folder / draft}/{name}")
            held[name] = checksum(written)
    manifest = json.dumps({"settings": settings, "tables": held}, sort_keys=True)
    spark.createDataFrame([(manifest,)], "manifest string").coalesce(1).write.parquet(f"{folder / draft}/manifest")
    while True:
        taken = versions(spark, path)
        version = f"v{int(taken[-1][1:]) + 1 if taken else 1:06d}"
        if folder.publish(draft, version, keep=True):
            return version


def load_model(spark: SparkSession, path: str, version: str | None = None) -> Model:
    """A version of the model, the last one by default, checked against its manifest."""
    found = versions(spark, path)
    if not found or (version is not None and version not in found):
        raise ValueError(f"no {version or 'model'} in {path}")
    root = f"{path.rstrip('/')}/{version or found[-1]}"
    manifest = json.loads(spark.read.parquet(f"{root}/manifest").first()["manifest"])
    tables = {}
    for name, (rows, total) in manifest["tables"].items():
        tables[name] = spark.read.parquet(f"{root}/{name}")
        if checksum(tables[name]) != (rows, total):
            raise ValueError(f"{root}/{name} isn't what was saved")
    return Model(version or found[-1], manifest["settings"], *(tables.get(name) for name in TABLES))


def score_texts(model: Model, docs: DataFrame, labels: DataFrame, threshold: float = logreg.THRESHOLD, on: str = "logit") -> DataFrame:
    """(doc_id, label, score, prediction) of texts under a loaded classifier."""
    k = model.settings["n_features"]
    examples = logreg.logreg_examples(text.featurize(docs, model.vocabulary), labels, k)
    return logreg.score_logreg(examples, model.weights, k, threshold, on)
