"""Helpers shared by the training-data operators: scratch tables and inputs."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage, survives lost executors, prunes columns on each read.
    The files belong to the run and go with its checkpoint folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ids_and_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) alone, a null text as empty: extra columns, whatever their
    names, never meet those that an operator adds."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def blocks(rows: int, per_block: int) -> int:
    """How many blocks hold ``rows`` at about ``per_block`` each, 1 at least."""
    return max(1, math.ceil(rows / per_block))
