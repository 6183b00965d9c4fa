"""Batch kNN category prediction over TF-IDF vectors.

All query texts run as one job and one plan, however many they are:

* ``score_documents`` is the declarative form, for all scores: TF-IDF rows join the query
  vectors on ``pos`` — only shared words multiply — and the dot products are summed per
  (query, document).  Query vectors within Spark's broadcast threshold leave TF-IDF in
  place, and its hash-partitioning by doc_id already satisfies the sums;
* ``knn_neighbors`` and ``top_scores`` need the best alone: one narrow pass over packed vectors
  (``strata.operators.vectors``) sums in arrays, and k rows per query leave a task;
* top-k per query has two stages: the best rows per hash part, then per query.

Documents that share no word with a query score 0 and can still be neighbours
when fewer than k documents score above 0.  Rather than scoring all pairs, the
2k smallest document ids (a bounded set) are added with score 0 and duplicates
are merged after the limit; this is exact for the tie rule (score desc, id asc)
because scores are never negative (TF ≥ 0 and idf = ln(N/df) ≥ 0, as df ≤ N).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.numeric import round_score
from strata.functions.text import tokenize
from strata.operators.common import GROUP_PARTS, top_n, top_n_per_group
from strata.operators.text import term_frequency
from strata.operators.vectors import Packed, best_documents, pack_vectors
from strata.session import Scratch


METRICS = ("cosine", "dot")


class QuerySet(NamedTuple):
    vectors: DataFrame  # (query_id, pos, value)


def query_vectors(
    queries: DataFrame, vocab: DataFrame, idf: DataFrame, scratch: Scratch | None = None
) -> QuerySet:
    """(query_id, text) → TF-IDF vectors (query_id, pos, value) against the corpus
    vocabulary and IDF.  A query without a vocabulary word has no rows.  With
    ``scratch`` the vectors are stored, as scoring reads them several times."""
    tokens = queries.select(
        F.col("query_id").alias("doc_id"), F.explode(tokenize("text")).alias("word")
    )
    positions = tokens.join(vocab.select("word", "pos"), "word")
    tf = term_frequency(positions.select("doc_id", "pos"))
    vectors = tf.join(idf, "pos").select(
        F.col("doc_id").alias("query_id"), "pos", (F.col("tf") * F.col("idf")).alias("value")
    )
    return QuerySet(scratch.table(vectors) if scratch else vectors)


def _unit(df: DataFrame, key: str, value: str) -> DataFrame:
    """``value`` divided by the L2 norm of its ``key``'s values; 0 where that is 0."""
    norm = F.sqrt(F.sum(F.col(value) * F.col(value)).over(Window.partitionBy(key)))
    return df.withColumn(value, F.coalesce(F.try_divide(F.col(value), norm), F.lit(0.0)))


def score_documents(
    tfidf: DataFrame, qs: QuerySet, metric: str = "cosine", k: int | None = None, packed: Packed | None = None
) -> DataFrame:
    """(query_id, doc_id, score) for every pair sharing at least one position.

    ``dot``: Σ v·q.  ``cosine``: Σ v·q / (‖v‖ ‖q‖), 0 when a norm is 0.  Written out, it has
    a row for nearly every pair.  With ``k`` the sums are made in arrays, and only rows
    that can be among the k best of a query (ties by doc_id) leave a task; they read
    ``packed``, the same vectors with one row per document, where these are stored."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    if k is not None:
        packed = packed or Packed(pack_vectors(tfidf.select("doc_id", "pos", "value")))
        return best_documents(packed, qs.vectors, k, metric == "cosine", zeros=True)
    docs = tfidf.select("doc_id", "pos", "value")
    queries = qs.vectors.select("query_id", "pos", F.col("value").alias("q"))
    if metric == "cosine":  # unit vectors: the sums carry no norms
        docs, queries = _unit(docs, "doc_id", "value"), _unit(queries, "query_id", "q")
    sums = docs.join(queries, "pos").groupBy("query_id", "doc_id")
    return sums.agg(F.sum(F.col("value") * F.col("q")).alias("score"))


def top_scores(
    tfidf: DataFrame, qs: QuerySet, k: int = 10, metric: str = "cosine", packed: Packed | None = None
) -> DataFrame:
    """The k best scores of each query among documents that share a word with it:
    (query_id, doc_id, score), score rounded to 9 decimals, ties by doc_id."""
    scored = score_documents(tfidf, qs, metric, k, packed).select("query_id", "doc_id", round_score("score").alias("score"))
    best = top_n_per_group(scored, "query_id", k, [F.col("score").desc(), F.col("doc_id").asc()])
    return best.select("query_id", "doc_id", "score")


def knn_neighbors(
    tfidf: DataFrame,
    qs: QuerySet,
    k: int = 10,
    metric: str = "cosine",
    restrict_to: DataFrame | None = None,
    packed: Packed | None = None,
) -> DataFrame:
    """Top-k documents per query: (query_id, rank, doc_id, score), score rounded
    to 9 decimals, ties by doc_id.  ``restrict_to`` (doc_id) limits the candidates.
    ``packed`` as in ``score_documents``."""
    if restrict_to is not None:
        # Whole documents drop out, so document norms are unchanged; the semi join
        # keeps TF-IDF's partitioning by doc_id and shrinks the scoring work.
        wanted = restrict_to.select("doc_id").distinct()
        tfidf = tfidf.join(wanted, "doc_id", "left_semi")
        packed = packed and packed._replace(rows=packed.rows.join(wanted, "doc_id", "left_semi"))
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    candidates = packed.rows.select("doc_id") if packed else tfidf.select("doc_id").distinct()
    packed = packed or Packed(pack_vectors(tfidf.select("doc_id", "pos", "value")))
    scored = best_documents(packed, qs.vectors, k, metric == "cosine")

    # Score-0 fill: the 2k smallest candidate ids, for every query that has a vector.
    first_ids = top_n(candidates, 2 * k, [F.col("doc_id").asc()]).agg(
        F.collect_list("doc_id")
    )
    live_queries = qs.vectors.select("query_id").distinct()
    zeros = live_queries.select(
        "query_id", F.explode(first_ids.scalar()).alias("doc_id"), F.lit(0.0).alias("score")
    )

    # Dealt by (query, hash part) once, rows of a document meet and are ranked there; a
    # query's best of all parts meet after that.
    order = [F.col("score").desc(), F.col("doc_id").asc()]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(GROUP_PARTS)).alias("_part")
    dealt = scored.unionByName(zeros).select("*", part).repartition("query_id", "_part")
    merged = dealt.groupBy("query_id", "_part", "doc_id").agg(F.max("score").alias("score"))
    first = Window.partitionBy("query_id", "_part").orderBy(*order)
    heads = merged.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    whole = Window.partitionBy("query_id").orderBy(*order)
    best = heads.withColumn("rank", F.row_number().over(whole).cast("bigint")).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "doc_id", "score")


def knn_vote_documents(neighbors: DataFrame, links: DataFrame, k: int = 10) -> DataFrame:
    """Document voting: every link of every neighbour is one vote for its category.
    Top ``k`` categories per query by votes, ties by category: (query_id, category, votes)."""
    joined = links.join(neighbors.select("query_id", "doc_id"), "doc_id")
    votes = joined.groupBy("query_id", "category").agg(F.count(F.lit(1)).alias("votes"))
    ranked = top_n_per_group(
        votes, "query_id", k, [F.col("votes").desc(), F.col("category").asc()]
    )
    return ranked.select("query_id", "category", "votes")


def knn_vote_pairs(
    tfidf: DataFrame, qs: QuerySet, links: DataFrame, k: int = 10, metric: str = "dot", packed: Packed | None = None
) -> DataFrame:
    """Pair voting: rank (category, document) pairs by the document's score, take
    the top k pairs, count them per category; top ``k`` categories per query.

    Only documents with a link form pairs.  The top k pairs come from the top k
    linked documents (each has ≥ 1 link), so only their links are joined — the
    vectors are never multiplied by categories."""
    top_docs = knn_neighbors(tfidf, qs, k, metric, links, packed)
    pairs = links.join(top_docs.select("query_id", "doc_id", "score"), "doc_id")
    top_pairs = top_n_per_group(
        pairs,
        "query_id",
        k,
        [F.col("score").desc(), F.col("doc_id").asc(), F.col("category").asc()],
    )
    votes = top_pairs.groupBy("query_id", "category").agg(F.count(F.lit(1)).alias("votes"))
    ranked = top_n_per_group(
        votes, "query_id", k, [F.col("votes").desc(), F.col("category").asc()]
    )
    return ranked.select("query_id", "category", "votes")


def knn_predict(
    tfidf: DataFrame,
    qs: QuerySet,
    links: DataFrame,
    k: int = 10,
    metric: str = "cosine",
    vote: str = "documents",
    packed: Packed | None = None,
) -> DataFrame:
    """Predicted categories per query.  Defaults: cosine, document voting."""
    if vote == "documents":
        return knn_vote_documents(knn_neighbors(tfidf, qs, k, metric, packed=packed), links, k)
    if vote == "pairs":
        return knn_vote_pairs(tfidf, qs, links, k, metric, packed)
    raise ValueError("vote must be 'documents' or 'pairs'")
