"""Shared plan pieces: ordered top-n, top-n per group, bounded numbering, previews.

No piece changes its plan with the size of its input: joins carry no hint, so Catalyst
broadcasts a side only by its own statistics (a ``limit``, a written table), and large
groups are split into parts before they meet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Parts that a group is split into before its best rows meet in one task.
GROUP_PARTS = 32


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """Global top-n.  Planned as TakeOrderedAndProject: each partition keeps n rows,
    one task merges them, so at most n × partitions rows leave the scan."""
    return df.orderBy(*order).limit(n)


def top_n_per_group(
    df: DataFrame, group: str | Sequence[str], n: int, order: Sequence[Column], rank: str = "rank"
) -> DataFrame:
    """Top-n rows per group with a 1-based ``rank`` (bigint), in two stages: the best n
    of each (group, part), then of each group.  A task's rows are of one part, so n rows
    of a group leave it; parts dealt by a hash of the row would let n × GROUP_PARTS pass.
    The last stage reads n × GROUP_PARTS rows of a group at most, whatever n and however
    large the group."""
    keys = [group] if isinstance(group, str) else list(group)
    part = F.pmod(F.spark_partition_id(), F.lit(GROUP_PARTS))
    first = Window.partitionBy(*keys, "_part").orderBy(*order)
    heads = df.withColumn("_part", part).withColumn(rank, F.row_number().over(first))
    heads = heads.where(F.col(rank) <= n).drop("_part", rank)
    whole = Window.partitionBy(*keys).orderBy(*order)
    ranked = heads.withColumn(rank, F.row_number().over(whole).cast("bigint"))
    return ranked.where(F.col(rank) <= n)


def preview(df: DataFrame, key: str, n: int) -> DataFrame:
    """All rows of the ``n`` smallest ``key`` values (e.g. the first n document
    vectors): a semi join with n keys."""
    keys = top_n(df.select(key).distinct(), n, [F.col(key).asc()])
    return df.join(keys, key, "left_semi")


def number_rows(df: DataFrame, order: Sequence[Column], name: str, start: int = 0) -> DataFrame:
    """Dense numbering of an already *bounded* frame (e.g. after ``limit``).

    A window without partitioning runs in one task, so callers must bound ``df``
    first (vocabulary ≤ K rows)."""
    w = Window.orderBy(*order)
    return df.withColumn(name, (F.row_number().over(w) - F.lit(1 - start)).cast("bigint"))
