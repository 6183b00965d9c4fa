"""Readers: trip CSV, text lines, document lines, category links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.text import (
    BODY_MARKER,
    ID_MARKER,
    URL_MARKER,
    doc_line_id,
    doc_line_text,
    is_doc_line,
    link_category,
    link_doc_id,
)

TRIP_WIDTH = 17
# Headerless trip CSV: 17 positional string fields c0..c16.  An explicit schema:
# short rows get nulls (and then fail cleaning), extra fields are cut, and no job
# is spent inferring anything.
TRIP_SCHEMA = T.StructType(
    [T.StructField(f"c{i}", T.StringType(), True) for i in range(TRIP_WIDTH)]
)


def read_trips(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw trip records, every field a string (c0..c16)."""
    return spark.read.schema(TRIP_SCHEMA).option("header", "false").csv(path)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per text line, column ``value``."""
    return spark.read.text(path)


def parse_doc_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Document lines → (doc_id, text); lines without the three markers are dropped."""
    line = F.col(column)
    return lines.where(is_doc_line(line)).select(
        doc_line_id(line).alias("doc_id"), doc_line_text(line).alias("text")
    )


def judged_doc_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """(doc_id, text, reason) of every line; ``reason`` names the first marker it lacks, null for a
    document line."""
    line = F.col(column)
    reason = F.lit(None).cast("string")
    for name, marker in reversed([("id", ID_MARKER), ("url", URL_MARKER), ("body", BODY_MARKER)]):
        reason = F.when(F.coalesce(F.locate(marker, line), F.lit(0)) == 0, f"no {name} marker").otherwise(reason)
    return lines.select(doc_line_id(line).alias("doc_id"), doc_line_text(line).alias("text"), reason.alias("reason"))


def read_doc_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_doc_lines(read_lines(spark, path))


def parse_category_links(lines: DataFrame, column: str = "value") -> DataFrame:
    """``"ID","CATEGORY"`` lines → (doc_id, category).

    Split at every comma, so a category holding a comma is cut at it; a line
    without a comma has no category and is dropped.
    """
    line = F.col(column)
    return lines.select(
        link_doc_id(line).alias("doc_id"), link_category(line).alias("category")
    ).where(F.col("category").isNotNull())


def judged_category_links(lines: DataFrame, column: str = "value") -> DataFrame:
    """(doc_id, category, reason) of every line; ``reason`` is null for a link."""
    line = F.col(column)
    found = lines.select(link_doc_id(line).alias("doc_id"), link_category(line).alias("category"))
    return found.withColumn("reason", F.when(F.col("category").isNull(), "no category"))


def read_category_links(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_category_links(read_lines(spark, path))


def corpus_size(lines: DataFrame) -> DataFrame:
    """Number of lines (all of them, valid or not) as a one-row frame ``n``."""
    return lines.agg(F.count(F.lit(1)).alias("n"))
