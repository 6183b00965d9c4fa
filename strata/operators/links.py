"""Statistics of a document–category link table (doc_id, category)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.common import top_n

# Accuracy of the approximate median (Spark's default, as in the reference).
MEDIAN_ACCURACY = 10000


def categories_per_doc(links: DataFrame) -> DataFrame:
    """(doc_id, count).  Repeated links count twice."""
    return links.groupBy("doc_id").agg(F.count(F.lit(1)).alias("count"))


def docs_per_category(links: DataFrame) -> DataFrame:
    """(category, count).  Combined map-side, so a huge category costs one row per task."""
    return links.groupBy("category").agg(F.count(F.lit(1)).alias("count"))


def describe_counts(counts: DataFrame, column: str = "count") -> DataFrame:
    """count, mean, sample stddev, min and max of a count column, as numbers."""
    return describe_and_median(counts, column).drop("median")


def describe_and_median(counts: DataFrame, column: str = "count") -> DataFrame:
    """``describe_counts`` and ``median_count`` in one pass, as one row."""
    c = F.col(column)
    return counts.agg(
        F.count(c).alias("n"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("stddev"),
        F.min(c).cast("bigint").alias("min"),
        F.max(c).cast("bigint").alias("max"),
        F.percentile_approx(c, 0.5, MEDIAN_ACCURACY).cast("bigint").alias("median"),
    )


def median_count(counts: DataFrame, column: str = "count") -> DataFrame:
    """Approximate median (an element of the column, the lower middle when exact)."""
    return describe_and_median(counts, column).select("median")


def exact_median(counts: DataFrame, column: str = "count", bins: int = 1024) -> DataFrame:
    """The exact median of a whole-number column (the lower middle; null if there is none) as one row ``median``.

    Selection by histogram: each pass counts the values in ``bins`` equal parts of the
    range that still holds the middle and goes on in its part, so log(range) / log(bins)
    passes send a bounded histogram each, however many rows and however skewed."""
    c = F.col(column)
    low, high, n = counts.agg(F.min(c), F.max(c), F.count(c)).first()
    rank = (n + 1) // 2  # of the middle, from 1 within the range
    while n and low < high:
        width = (high - low) // bins + 1
        part = F.floor((c - low) / width).cast("long").alias("part")
        rows = counts.where(c.between(low, high)).groupBy(part).agg(F.count(F.lit(1)).alias("rows")).orderBy("part").collect()
        for row in rows:  # at most ``bins``
            if rank <= row["rows"]:
                low, high = low + row["part"] * width, min(high, low + (row["part"] + 1) * width - 1)
                break
            rank -= row["rows"]
    return counts.sparkSession.createDataFrame([(low,)], "median bigint")


def top_categories(links: DataFrame, n: int = 10) -> DataFrame:
    return top_n(
        docs_per_category(links), n, [F.col("count").desc(), F.col("category").asc()]
    )
