"""Sinks: results as structured files instead of Python reprs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_result(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    single_file: bool = False,
    mode: str = "overwrite",
) -> None:
    """Write a result, in parallel by default.  ``single_file`` is for small results
    (top-k lists, summaries): their rows meet in one task after the work is done, which
    keeps its own partitions.  ``text`` writes one column as it is, more as JSON."""
    out = df.repartition(1) if single_file else df
    if fmt == "text" and df.dtypes != [(df.columns[0], "string")]:
        out = out.select(F.to_json(F.struct(*df.columns)).alias("value"))
    writer = out.write.mode(mode)
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    elif fmt == "json":
        writer.json(path)
    elif fmt == "parquet":
        writer.parquet(path)
    elif fmt == "text":
        writer.text(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
