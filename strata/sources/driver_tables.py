"""Views of the driver's parquet tables in the input shapes of the three workloads.

The same views are written in SQL for the DuckDB oracle (``strata.plans.oracle``).
Every view reads whole tables; the modulo expressions below only inject bad field
values or pick the train/test half — no row is capped or skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.readers import TRIP_WIDTH, parse_category_links

S = "string"


# Set by a caller that knows its inputs to be single row groups (the bench): the views
# that parse or tokenize then deal their input out to so many partitions.
PARTITIONS: int | None = None


def table(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    """A driver table as its files are split; with ``partitions`` dealt out evenly."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.repartition(partitions) if partitions else df


def trips_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as 17-field string trip records, with bad, null and NaN fields
    and null drivers mixed in.  Positions never read hold ''."""
    li = table(spark, sf_dir, "lineitem", PARTITIONS)
    null = F.lit(None).cast(S)
    fields = {
        0: F.concat(F.lit("V"), li.l_suppkey.cast(S)),
        1: F.when(li.l_partkey % 50 == 0, null).otherwise(
            F.concat(F.lit("D"), li.l_partkey.cast(S))
        ),
        4: (li.l_quantity * 30).cast(S),
        5: F.when(li.l_orderkey % 97 == 0, F.lit("bad"))
        .when(li.l_orderkey % 89 == 0, null)
        .otherwise((li.l_discount * 10).cast(S)),
        11: F.when(li.l_orderkey % 83 == 0, F.lit("nan")).otherwise(
            li.l_extendedprice.cast(S)
        ),
        16: F.when(li.l_orderkey % 79 == 0, null).otherwise(
            (li.l_extendedprice * (1 + li.l_tax)).cast(S)
        ),
    }
    return li.select(
        *[fields.get(i, F.lit("")).alias(f"c{i}") for i in range(TRIP_WIDTH)]
    )


def link_lines_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category links rendered as ``"ID","CATEGORY"`` text lines (column ``value``):
    language and source of every document, quality and toxicity of labelled ones."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    pairs = (
        docs.select(docs.doc_id.cast(S).alias("d"), F.concat(F.lit("lang_"), docs.lang).alias("c"))
        .unionByName(docs.select(docs.doc_id.cast(S).alias("d"), docs.source.alias("c")))
        .unionByName(
            labels.select(
                labels.doc_id.cast(S).alias("d"),
                F.concat(F.lit("quality_"), labels.quality.cast(S)).alias("c"),
            )
        )
        .unionByName(
            labels.select(
                labels.doc_id.cast(S).alias("d"),
                F.concat(F.lit("toxic_"), labels.toxic.cast(S)).alias("c"),
            )
        )
    )
    return pairs.select(
        F.concat(F.lit('"'), F.col("d"), F.lit('","'), F.col("c"), F.lit('"')).alias("value")
    )


def links_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, category) parsed from the link lines."""
    return parse_category_links(link_lines_view(spark, sf_dir))


def doc_lines_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` rebuilt as ``<doc id=".." url=".." title="t">HTML</doc>`` lines."""
    pages = table(spark, sf_dir, "pages", PARTITIONS)
    return pages.select(
        F.concat(
            F.lit('<doc id="'),
            pages.page_id.cast(S),
            F.lit('" url="'),
            pages.url,
            F.lit('" title="t">'),
            pages.html,
            F.lit("</doc>"),
        ).alias("value")
    )


def as_doc_lines(df: DataFrame, doc_id, text) -> DataFrame:
    """Render (doc_id, text) columns as document lines (column ``value``) for
    line-based files; newlines inside the text become spaces (both are
    non-letters, so tokens are unchanged)."""
    return df.select(
        F.concat(
            F.lit('<doc id="'), doc_id, F.lit('" url="u" title="t">'),
            F.regexp_replace(text, "[\\r\\n]", " "), F.lit("</doc>"),
        ).alias("value")
    )


def write_workload_inputs(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """Write the three workloads' raw inputs, derived from the driver tables, as
    files under ``root``: trip CSV, corpus document lines, category-link lines,
    and train/test document lines whose ids carry 'AU' for positive labels."""
    paths = {name: f"{root.rstrip('/')}/{name}" for name in ("trips", "pages", "links", "train", "test")}
    trips_view(spark, sf_dir).write.option("nullValue", "").csv(paths["trips"])
    corpus = corpus_view(spark, sf_dir)
    as_doc_lines(corpus, F.col("doc_id"), F.col("text")).write.text(paths["pages"])
    link_lines_view(spark, sf_dir).write.text(paths["links"])
    for split in ("train", "test"):
        docs = labelled_view(spark, sf_dir, split)
        doc_id = F.concat(F.when(F.col("label") == 1, F.lit("AU")).otherwise(F.lit("")), F.col("doc_id"))
        as_doc_lines(docs, doc_id, F.col("text")).write.text(paths[split])
    return paths


def corpus_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text corpus (doc_id, text) from ``documents``."""
    docs = table(spark, sf_dir, "documents", PARTITIONS)
    return docs.select(docs.doc_id.cast(S).alias("doc_id"), docs.text)


def query_texts_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """kNN query texts (query_id, text) from ``benchmark``."""
    bench = table(spark, sf_dir, "benchmark", PARTITIONS)
    return bench.select(bench.item_id.cast(S).alias("query_id"), bench.text)


def conversation_view(spark: SparkSession, sf_dir: str, split: str) -> DataFrame:
    """Conversation turns as documents (doc_id, text) whose ids repeat over the turns;
    ``split`` as in ``labelled_view``, by conv_id."""
    rows = table(spark, sf_dir, "conversations", PARTITIONS)
    return _half(rows, "conv_id", split).select(F.col("conv_id").cast(S).alias("doc_id"), "text")


def _half(rows: DataFrame, key: str, split: str) -> DataFrame:
    if split == "train":
        return rows.where(F.col(key) % 5 != 0)
    if split == "test":
        return rows.where(F.col(key) % 5 == 0)
    if split != "all":
        raise ValueError(f"unknown split {split!r}")
    return rows


def labelled_view(spark: SparkSession, sf_dir: str, split: str) -> DataFrame:
    """Labelled documents (doc_id, text, label = quality).

    ``split='train'`` keeps doc_id % 5 <> 0, ``'test'`` the rest, ``'all'`` both:
    train and test together cover every labelled document.
    """
    docs = table(spark, sf_dir, "documents", PARTITIONS)
    labels = table(spark, sf_dir, "labels", PARTITIONS)
    joined = _half(docs.join(labels, "doc_id"), "doc_id", split)
    return joined.select(
        F.col("doc_id").cast(S).alias("doc_id"), "text", F.col("quality").alias("label")
    )
