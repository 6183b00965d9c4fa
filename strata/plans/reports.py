"""File-in, file-out reports: the three workloads run from their raw input files
(trip CSV, document lines, category links) to structured result files.

Each report is a set of DataFrame plans written with ``write_result``, in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators import knn, links, logreg, text, trips
from strata.operators.common import preview
from strata.plans.catalog import LOOKUP_WORDS
from strata.session import Scratch
from strata.sources.readers import (
    corpus_size,
    parse_doc_lines,
    read_category_links,
    read_lines,
    read_trips,
)
from strata.sources.sinks import write_result


def trips_report(spark: SparkSession, trips_path: str, out_dir: str, n: int = 10, fmt: str = "parquet") -> None:
    """Top ``n`` vehicles by distinct drivers and top ``n`` drivers by mean
    earnings per minute, from a headerless 17-field trip CSV."""
    clean = trips.clean_trips(read_trips(spark, trips_path))
    write_result(trips.top_vehicles(clean, n), f"{out_dir}/top_vehicles", fmt)
    write_result(trips.top_drivers(clean, n), f"{out_dir}/top_drivers", fmt)


def corpus_report(
    spark: SparkSession,
    pages_path: str,
    links_path: str,
    queries: DataFrame,
    out_dir: str,
    k: int = text.CORPUS_VOCABULARY,
    knn_k: int = 10,
    fmt: str = "parquet",
) -> text.TextFeatures:
    """Document lines + category links → corpus size, top words, vocabulary tail,
    TF and TF-IDF samples and tables, kNN category votes for ``queries``
    (query_id, text) by document voting (cosine) and pair voting (dot), and the
    link statistics.  The links are read once, and so is the number of lines.
    Returns the fitted text features (``release()`` drops what is stored)."""
    lines = read_lines(spark, pages_path)
    docs = parse_doc_lines(lines)
    n_lines = corpus_size(lines)
    n = n_lines.first()["n"]
    features = text.text_features(docs, k, n_docs=n)
    scratch = features.scratch
    link_table = scratch.table(read_category_links(spark, links_path))

    write_result(spark.createDataFrame([(n,)], n_lines.schema), f"{out_dir}/corpus_size", fmt)
    # The vocabulary holds the top K words in the same order; a smaller K lists fewer.
    write_result(text.top_words(features.vocab.select("word", "count"), 10), f"{out_dir}/top_words", fmt)
    write_result(text.vocabulary_tail(features.vocab, 20), f"{out_dir}/vocabulary_tail", fmt)
    write_result(preview(features.tf, "doc_id", 3), f"{out_dir}/tf_sample", fmt)
    write_result(preview(features.tfidf, "doc_id", 2), f"{out_dir}/tfidf_sample", fmt)
    write_result(features.tfidf, f"{out_dir}/tf_idf", fmt)

    qs = knn.query_vectors(queries, features.vocab, features.idf, scratch)
    write_result(
        knn.knn_predict(features.tfidf, qs, link_table, knn_k, "cosine", "documents", packed=features.vectors),
        f"{out_dir}/knn_documents", fmt,
    )
    write_result(
        knn.knn_predict(features.tfidf, qs, link_table, knn_k, "dot", "pairs", packed=features.vectors),
        f"{out_dir}/knn_pairs", fmt,
    )

    per_doc = links.categories_per_doc(link_table)
    both = links.describe_and_median(per_doc)
    both = spark.createDataFrame(both.collect(), both.schema)  # one row
    write_result(both.drop("median"), f"{out_dir}/categories_per_doc_summary", fmt)
    write_result(both.select("median"), f"{out_dir}/categories_per_doc_median", fmt)
    write_result(links.top_categories(link_table, 10), f"{out_dir}/top_categories", fmt)
    return features


def classifier_report(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    out_dir: str,
    k: int = text.CLASSIFIER_VOCABULARY,
    needle: str = "AU",
    fmt: str = "parquet",
    **fit_options,
) -> logreg.FitResult:
    """Train and test document lines (label: ``needle`` occurs in the id) →
    word lookups, cost history, strongest words, confusion matrix and metrics.
    ``fit_options`` override the training settings of ``fit_logreg``."""
    train = parse_doc_lines(read_lines(spark, train_path))
    test = parse_doc_lines(read_lines(spark, test_path))
    scratch = Scratch(spark)
    vocab = scratch.table(text.build_vocabulary(text.word_counts(text.doc_tokens(train)), k))

    words = spark.createDataFrame([(w,) for w in LOOKUP_WORDS], "word string")
    write_result(text.vocab_lookup(vocab, words), f"{out_dir}/lookups", fmt)

    def examples(docs: DataFrame) -> DataFrame:
        return logreg.logreg_examples_by_id(text.featurize(docs, vocab), k, needle)

    fit = logreg.fit_logreg(examples(train), k, **fit_options)
    write_result(fit.history, f"{out_dir}/cost_history", fmt)
    write_result(logreg.top_weighted_words(fit.weights, vocab, k), f"{out_dir}/top_words", fmt)

    scored = logreg.score_logreg(examples(test), fit.weights, k)
    metrics = logreg.classification_metrics(logreg.confusion_matrix(scored))
    write_result(metrics, f"{out_dir}/metrics", fmt)
    scratch.release()
    return fit
