"""The named query catalog over the driver tables.

Each entry takes (spark, sf_dir) and returns a DataFrame.  Computed columns carry
the same names as in the SQL oracle (``strata.plans.oracle``); floating results are
rounded to 9 decimals so that sums added in another order compare equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.numeric import round_score
from strata.operators import knn, links, logreg, model, text, trips
from strata.operators.common import preview
from strata.session import Scratch
from strata.sources import driver_tables as views
from strata.sources.readers import (
    corpus_size,
    judged_category_links,
    judged_doc_lines,
    parse_doc_lines,
    read_category_links,
    read_doc_lines,
    read_lines,
    read_trips,
)
from strata.sources.sinks import write_result

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the catalog queries.  Vocabulary sizes and training settings are
# the reference's; the three-step full-batch fit is the SQL-checkable form.
TOP_N = 10
TAIL_N = 20
KNN_K = 10
CORPUS_K = text.CORPUS_VOCABULARY
CLASSIFIER_K = text.CLASSIFIER_VOCABULARY
SUBSTRING_NEEDLE = "77"
FULLBATCH_STEPS = 3
MINIBATCH_STEPS, MINIBATCH_SIZE, MINIBATCH_TOLERANCE = 6, 20, 0.05
ID_NEEDLE = "7"
TOP_WORDS_N = 5
TF_PREVIEW_DOCS = 3
TFIDF_PREVIEW_DOCS = 2
# The words the reference looks up in its classifier dictionary.
LOOKUP_WORDS = ["applicant", "and", "attack", "protein", "car", "in"]
# The reference's three kNN query texts.
REFERENCE_TEXTS = [
    ("t1", "Sport Basketball Volleyball Soccer"),
    ("t2", "What is the capital city of Australia?"),
    ("t3", "How many goals Vancouver score last year?"),
]


# What catalog queries have stored and still read; ``release`` drops it.
_STORED: list[Scratch] = []


def release() -> None:
    """Drop everything that queries of this catalog have stored.  Their results can't
    be read afterwards."""
    while _STORED:
        _STORED.pop().release()


def _scratch(spark: SparkSession) -> Scratch:
    _STORED.append(Scratch(spark))
    return _STORED[-1]


def _r(column: str, alias: str | None = None, decimals: int = 9):
    return round_score(column, decimals).alias(alias or column)


# ----------------------------------------------------------------------------- trips


def q_clean_trips(spark: SparkSession, sf: str) -> DataFrame:
    return trips.clean_trips(views.trips_view(spark, sf))


def q_distinct_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return trips.distinct_pairs(q_clean_trips(spark, sf))


def q_drivers_per_vehicle(spark: SparkSession, sf: str) -> DataFrame:
    return trips.distinct_per_key(q_clean_trips(spark, sf))


def q_top_vehicles(spark: SparkSession, sf: str) -> DataFrame:
    return trips.top_vehicles(q_clean_trips(spark, sf), TOP_N)


def q_mean_rate_per_driver(spark: SparkSession, sf: str) -> DataFrame:
    rates = trips.mean_rate_per_key(q_clean_trips(spark, sf))
    return rates.select("driver", _r("rate", decimals=trips.RATE_DECIMALS))


def q_top_drivers(spark: SparkSession, sf: str) -> DataFrame:
    top = trips.top_drivers(q_clean_trips(spark, sf), TOP_N)
    return top.select("driver", _r("rate", decimals=trips.RATE_DECIMALS))


# ----------------------------------------------------------------- lines and links


def q_doc_lines_parsed(spark: SparkSession, sf: str) -> DataFrame:
    return parse_doc_lines(views.doc_lines_view(spark, sf))


def q_corpus_size(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_size(views.doc_lines_view(spark, sf))


def q_category_links(spark: SparkSession, sf: str) -> DataFrame:
    return views.links_view(spark, sf)


def q_categories_per_doc(spark: SparkSession, sf: str) -> DataFrame:
    return links.categories_per_doc(views.links_view(spark, sf))


def q_docs_per_category(spark: SparkSession, sf: str) -> DataFrame:
    return links.docs_per_category(views.links_view(spark, sf))


def q_describe_counts(spark: SparkSession, sf: str) -> DataFrame:
    summary = links.describe_counts(q_categories_per_doc(spark, sf))
    return summary.select("n", _r("mean"), _r("stddev"), "min", "max")


def q_median_count(spark: SparkSession, sf: str) -> DataFrame:
    return links.median_count(q_categories_per_doc(spark, sf))


def q_top_categories(spark: SparkSession, sf: str) -> DataFrame:
    return links.top_categories(views.links_view(spark, sf), TOP_N)


# ------------------------------------------------------------------- text features


def _corpus(spark: SparkSession, sf: str) -> text.TextFeatures:
    features = text.text_features(views.corpus_view(spark, sf), CORPUS_K)
    _STORED.append(features.scratch)
    return features


def _frequencies(spark: SparkSession, sf: str) -> text.TextFeatures:
    features = text.text_frequencies(views.corpus_view(spark, sf), CORPUS_K)
    _STORED.append(features.scratch)
    return features


def _word_counts(spark: SparkSession, sf: str) -> DataFrame:
    return text.word_counts(text.doc_tokens(views.corpus_view(spark, sf)))


def q_word_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _word_counts(spark, sf)


def q_top_words(spark: SparkSession, sf: str) -> DataFrame:
    return text.top_words(_word_counts(spark, sf), TOP_N)


def q_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return text.build_vocabulary(_word_counts(spark, sf), CORPUS_K)


def q_vocabulary_tail(spark: SparkSession, sf: str) -> DataFrame:
    return text.vocabulary_tail(q_vocabulary(spark, sf), TAIL_N)


def _classifier_vocab(spark: SparkSession, sf: str) -> DataFrame:
    train = views.labelled_view(spark, sf, "train")
    vocab = text.build_vocabulary(text.word_counts(text.doc_tokens(train)), CLASSIFIER_K)
    return _scratch(spark).table(vocab)  # ≤ K rows, read by train and test


def q_vocab_lookup(spark: SparkSession, sf: str) -> DataFrame:
    words = spark.createDataFrame([(w,) for w in LOOKUP_WORDS], "word string")
    return text.vocab_lookup(_classifier_vocab(spark, sf), words)


def q_tokens_to_positions(spark: SparkSession, sf: str) -> DataFrame:
    tokens = text.doc_tokens(views.corpus_view(spark, sf))
    vocab = text.build_vocabulary(text.word_counts(tokens), CORPUS_K)
    return text.position_counts(text.tokens_to_positions(tokens, vocab))


def q_term_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return _frequencies(spark, sf).tf.select("doc_id", "pos", _r("tf"))


def q_binary_presence(spark: SparkSession, sf: str) -> DataFrame:
    return text.binary_presence(_frequencies(spark, sf).tf)


def q_document_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return _frequencies(spark, sf).doc_freq


def q_inverse_document_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return _corpus(spark, sf).idf.select("pos", _r("idf"))


def q_tf_idf(spark: SparkSession, sf: str) -> DataFrame:
    return _corpus(spark, sf).tfidf.select("doc_id", "pos", _r("value"))


def q_tf_preview(spark: SparkSession, sf: str) -> DataFrame:
    """The TF vectors of the first documents (by id) that have one."""
    return preview(_frequencies(spark, sf).tf, "doc_id", TF_PREVIEW_DOCS).select("doc_id", "pos", _r("tf"))


def q_tfidf_preview(spark: SparkSession, sf: str) -> DataFrame:
    tfidf = _corpus(spark, sf).tfidf
    return preview(tfidf, "doc_id", TFIDF_PREVIEW_DOCS).select("doc_id", "pos", _r("value"))


# ---------------------------------------------------------------------------- kNN


def _knn_inputs(spark: SparkSession, sf: str) -> tuple[text.TextFeatures, knn.QuerySet]:
    c = _corpus(spark, sf)
    return c, knn.query_vectors(views.query_texts_view(spark, sf), c.vocab, c.idf, c.scratch)


def q_query_vectors(spark: SparkSession, sf: str) -> DataFrame:
    _, qs = _knn_inputs(spark, sf)
    return qs.vectors.select("query_id", "pos", _r("value"))


def q_scores_cosine(spark: SparkSession, sf: str) -> DataFrame:
    """The best cosine scores of each query among documents that share a word."""
    c, qs = _knn_inputs(spark, sf)
    return knn.top_scores(c.tfidf, qs, KNN_K, "cosine", packed=c.vectors)


def q_scores_dot(spark: SparkSession, sf: str) -> DataFrame:
    """The best dot products of each query among documents that share a word."""
    c, qs = _knn_inputs(spark, sf)
    return knn.top_scores(c.tfidf, qs, KNN_K, "dot", packed=c.vectors)


def q_knn_neighbors(spark: SparkSession, sf: str) -> DataFrame:
    c, qs = _knn_inputs(spark, sf)
    return knn.knn_neighbors(c.tfidf, qs, KNN_K, "cosine", packed=c.vectors)


def q_knn_neighbors_dot(spark: SparkSession, sf: str) -> DataFrame:
    c, qs = _knn_inputs(spark, sf)
    return knn.knn_neighbors(c.tfidf, qs, KNN_K, "dot", packed=c.vectors)


def q_knn_vote_documents(spark: SparkSession, sf: str) -> DataFrame:
    c, qs = _knn_inputs(spark, sf)
    return knn.knn_predict(c.tfidf, qs, views.links_view(spark, sf), KNN_K, "cosine", "documents", packed=c.vectors)


def q_knn_reference_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The reference's three query texts against the whole corpus (cosine,
    document voting, k = 10)."""
    c = _corpus(spark, sf)
    texts = spark.createDataFrame(REFERENCE_TEXTS, "query_id string, text string")
    qs = knn.query_vectors(texts, c.vocab, c.idf, c.scratch)
    return knn.knn_predict(c.tfidf, qs, views.links_view(spark, sf), KNN_K, "cosine", "documents", packed=c.vectors)


def q_knn_vote_pairs(spark: SparkSession, sf: str) -> DataFrame:
    c, qs = _knn_inputs(spark, sf)
    return knn.knn_predict(c.tfidf, qs, views.links_view(spark, sf), KNN_K, "dot", "pairs", packed=c.vectors)


# --------------------------------------------------------------------- classifier


def q_label_by_substring(spark: SparkSession, sf: str) -> DataFrame:
    return logreg.label_by_substring(views.corpus_view(spark, sf), SUBSTRING_NEEDLE)


def _examples(spark: SparkSession, sf: str, split: str) -> DataFrame:
    vocab = _classifier_vocab(spark, sf)
    docs = views.labelled_view(spark, sf, split)
    tf = text.featurize(docs, vocab)
    return logreg.logreg_examples(tf, docs, CLASSIFIER_K)


def q_logreg_examples(spark: SparkSession, sf: str) -> DataFrame:
    return _examples(spark, sf, "train").select("doc_id", "label", "pos", _r("value"))


def q_logreg_train_size(spark: SparkSession, sf: str) -> DataFrame:
    """Training-set size: labelled training documents with at least one
    vocabulary word (the bias row marks each once)."""
    return logreg.train_size(_examples(spark, sf, "train"), CLASSIFIER_K)


def q_logreg_step(spark: SparkSession, sf: str) -> DataFrame:
    """Gradient (Σ x(σ(θ)−y) / n) at zero weights over the whole training set."""
    packed = logreg.pack_examples(_examples(spark, sf, "train"))
    zeros = logreg.initial_weights(CLASSIFIER_K, "zeros")
    sums = logreg.gradient_sums(packed, zeros, CLASSIFIER_K)
    n = sums.where(F.col("pos") == CLASSIFIER_K).select("n")
    return sums.select("pos", round_score(F.col("grad") / n.scalar()).alias("gradient"))


def _fullbatch(spark: SparkSession, sf: str) -> logreg.FitResult:
    return logreg.fit_logreg(
        _examples(spark, sf, "train"),
        CLASSIFIER_K,
        max_iteration=FULLBATCH_STEPS,
        batch_size=None,
        tolerance=0.0,
        init="zeros",
    )


def q_logreg_fit_fullbatch(spark: SparkSession, sf: str) -> DataFrame:
    return _fullbatch(spark, sf).weights.select("pos", _r("weight"))


def q_logreg_history(spark: SparkSession, sf: str) -> DataFrame:
    return _fullbatch(spark, sf).history.select("iteration", _r("cost"))


def _minibatch_checked(spark: SparkSession, sf: str) -> logreg.FitResult:
    """Real sampling and an early stop, in a form that SQL can redo."""
    return logreg.fit_logreg(
        _examples(spark, sf, "train"),
        CLASSIFIER_K,
        max_iteration=MINIBATCH_STEPS,
        batch_size=MINIBATCH_SIZE,
        tolerance=MINIBATCH_TOLERANCE,
        init="zeros",
    )


def q_logreg_minibatch_weights(spark: SparkSession, sf: str) -> DataFrame:
    return _minibatch_checked(spark, sf).weights.select("pos", _r("weight"))


def q_logreg_minibatch_history(spark: SparkSession, sf: str) -> DataFrame:
    return _minibatch_checked(spark, sf).history.select("iteration", _r("cost"))


def _examples_by_id(spark: SparkSession, sf: str, split: str, vocab: DataFrame) -> DataFrame:
    """Conversations: ids repeat over the turns, and the id holds the label."""
    tf = text.featurize(views.conversation_view(spark, sf, split), vocab)
    return logreg.logreg_examples_by_id(tf, CLASSIFIER_K, ID_NEEDLE)


def _vocab_by_id(spark: SparkSession, sf: str) -> DataFrame:
    tokens = text.doc_tokens(views.conversation_view(spark, sf, "train"))
    return _scratch(spark).table(text.build_vocabulary(text.word_counts(tokens), CLASSIFIER_K))


def q_logreg_examples_by_id(spark: SparkSession, sf: str) -> DataFrame:
    examples = _examples_by_id(spark, sf, "train", _vocab_by_id(spark, sf))
    return examples.select("doc_id", "label", "pos", _r("value"))


def q_logreg_train_size_by_id(spark: SparkSession, sf: str) -> DataFrame:
    return logreg.train_size(_examples_by_id(spark, sf, "train", _vocab_by_id(spark, sf)), CLASSIFIER_K)


def q_confusion_matrix_by_id(spark: SparkSession, sf: str) -> DataFrame:
    vocab = _vocab_by_id(spark, sf)
    train, test = (_examples_by_id(spark, sf, split, vocab) for split in ("train", "test"))
    fit = logreg.fit_logreg(
        train, CLASSIFIER_K, max_iteration=FULLBATCH_STEPS, batch_size=None, tolerance=0.0, init="zeros"
    )
    return logreg.confusion_matrix(logreg.score_logreg(test, fit.weights, CLASSIFIER_K))


def q_logreg_minibatch(spark: SparkSession, sf: str) -> DataFrame:
    """The reference's training call: 50 iterations, rate 0.6, L2 0.1, batch 20,000,
    tolerance 5e-5, N(0, 0.1) start.  Random start → checked by row count only."""
    fit = logreg.fit_logreg(_examples(spark, sf, "train"), CLASSIFIER_K)
    return fit.weights


def _scored_test(spark: SparkSession, sf: str) -> DataFrame:
    weights = _fullbatch(spark, sf).weights
    return logreg.score_logreg(_examples(spark, sf, "test"), weights, CLASSIFIER_K)


def q_logreg_score(spark: SparkSession, sf: str) -> DataFrame:
    return _scored_test(spark, sf).select("doc_id", "label", _r("score"), "prediction")


def q_confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return logreg.confusion_matrix(_scored_test(spark, sf))


def q_classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    m = logreg.classification_metrics(logreg.confusion_matrix(_scored_test(spark, sf)))
    return m.select("tp", "tn", "fp", "fn", _r("precision"), _r("recall"), _r("f1"), _r("accuracy"))


def q_top_weighted_words(spark: SparkSession, sf: str) -> DataFrame:
    weights = _fullbatch(spark, sf).weights
    top = logreg.top_weighted_words(weights, _classifier_vocab(spark, sf), CLASSIFIER_K, TOP_WORDS_N)
    return top.select("pos", "word", _r("weight"))


def q_logreg_score_loaded(spark: SparkSession, sf: str) -> DataFrame:
    """The test documents scored under a classifier that was saved and loaded again."""
    path = _scratch(spark).folder("model").path
    vocab = _classifier_vocab(spark, sf)
    settings = {"n_features": CLASSIFIER_K, "steps": FULLBATCH_STEPS}
    model.save_model(path, settings, vocab, _fullbatch(spark, sf).weights)
    docs = views.labelled_view(spark, sf, "test")
    scored = model.score_texts(model.load_model(spark, path), docs, docs)
    return scored.select("doc_id", "label", _r("score"), "prediction")


# ------------------------------------------------- files in and out, rows turned away


def _written(spark: SparkSession, df: DataFrame, name: str, fmt: str, single_file: bool = False) -> str:
    """``df`` as files of its own folder; their path."""
    folder = _scratch(spark).folder(name)
    write_result(df, folder.path, fmt, single_file)
    return folder.path


def q_trips_from_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Clean trips read from a headerless CSV file."""
    folder = _scratch(spark).folder("trips")
    views.trips_view(spark, sf).write.csv(folder.path)
    return trips.clean_trips(read_trips(spark, folder.path))


def q_corpus_size_from_text(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a text file, valid or not."""
    return corpus_size(read_lines(spark, _written(spark, views.doc_lines_view(spark, sf).select("value"), "lines", "text")))


def q_doc_lines_from_text(spark: SparkSession, sf: str) -> DataFrame:
    """Documents read from a text file of document lines."""
    return read_doc_lines(spark, _written(spark, views.doc_lines_view(spark, sf).select("value"), "pages", "text"))


def q_links_from_text(spark: SparkSession, sf: str) -> DataFrame:
    """Category links read from a text file."""
    return read_category_links(spark, _written(spark, views.link_lines_view(spark, sf).select("value"), "links", "text"))


def q_result_single_file(spark: SparkSession, sf: str) -> DataFrame:
    """The top vehicles written to a single CSV file with a header, and read back."""
    path = _written(spark, q_top_vehicles(spark, sf), "top", "csv", single_file=True)
    rows = spark.read.schema("vehicle string, drivers bigint").option("header", "true").csv(path)
    return rows.withColumn("files", F.lit(len(rows.inputFiles())))


def q_result_many_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents per category written in parallel as JSON text lines, and read back."""
    path = _written(spark, q_docs_per_category(spark, sf), "categories", "text")
    parsed = F.from_json("value", "category string, count bigint")
    return read_lines(spark, path).select(parsed.alias("row")).select("row.category", "row.count")


def q_rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    """(input, reason, rows): what every reader keeps and turns away, by the first rule broken."""
    judged = {
        "trips": trips.judged_trips(views.trips_view(spark, sf)),
        "doc_lines": judged_doc_lines(views.doc_lines_view(spark, sf)),
        "links": judged_category_links(views.link_lines_view(spark, sf)),
    }
    counted = [trips.reason_counts(df).select(F.lit(name).alias("input"), "reason", "rows") for name, df in judged.items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


# ------------------------------------------------------------- other plans, same results


def q_drivers_per_vehicle_bitmaps(spark: SparkSession, sf: str) -> DataFrame:
    return trips.distinct_per_key_bitmaps(q_clean_trips(spark, sf))


def q_median_exact(spark: SparkSession, sf: str) -> DataFrame:
    return links.exact_median(q_categories_per_doc(spark, sf))


def q_vocabulary_bounded(spark: SparkSession, sf: str) -> DataFrame:
    return text.vocabulary_in_bounded_memory(views.corpus_view(spark, sf), CORPUS_K)


QUERIES: dict[str, Query] = {
    "clean_trips": q_clean_trips,
    "distinct_pairs": q_distinct_pairs,
    "drivers_per_vehicle": q_drivers_per_vehicle,
    "top_vehicles": q_top_vehicles,
    "mean_rate_per_driver": q_mean_rate_per_driver,
    "top_drivers": q_top_drivers,
    "doc_lines_parsed": q_doc_lines_parsed,
    "corpus_size": q_corpus_size,
    "category_links": q_category_links,
    "categories_per_doc": q_categories_per_doc,
    "docs_per_category": q_docs_per_category,
    "describe_counts": q_describe_counts,
    "median_count": q_median_count,
    "top_categories": q_top_categories,
    "word_counts": q_word_counts,
    "top_words": q_top_words,
    "vocabulary": q_vocabulary,
    "vocabulary_tail": q_vocabulary_tail,
    "vocab_lookup": q_vocab_lookup,
    "tokens_to_positions": q_tokens_to_positions,
    "term_frequency": q_term_frequency,
    "binary_presence": q_binary_presence,
    "document_frequency": q_document_frequency,
    "inverse_document_frequency": q_inverse_document_frequency,
    "tf_idf": q_tf_idf,
    "tf_preview": q_tf_preview,
    "tfidf_preview": q_tfidf_preview,
    "query_vectors": q_query_vectors,
    "scores_cosine": q_scores_cosine,
    "scores_dot": q_scores_dot,
    "knn_neighbors": q_knn_neighbors,
    "knn_neighbors_dot": q_knn_neighbors_dot,
    "knn_vote_documents": q_knn_vote_documents,
    "knn_vote_pairs": q_knn_vote_pairs,
    "knn_reference_texts": q_knn_reference_texts,
    "label_by_substring": q_label_by_substring,
    "logreg_examples": q_logreg_examples,
    "logreg_train_size": q_logreg_train_size,
    "logreg_step": q_logreg_step,
    "logreg_fit_fullbatch": q_logreg_fit_fullbatch,
    "logreg_history": q_logreg_history,
    "logreg_minibatch": q_logreg_minibatch,
    "logreg_minibatch_weights": q_logreg_minibatch_weights,
    "logreg_minibatch_history": q_logreg_minibatch_history,
    "logreg_examples_by_id": q_logreg_examples_by_id,
    "logreg_train_size_by_id": q_logreg_train_size_by_id,
    "confusion_matrix_by_id": q_confusion_matrix_by_id,
    "logreg_score": q_logreg_score,
    "confusion_matrix": q_confusion_matrix,
    "classification_metrics": q_classification_metrics,
    "top_weighted_words": q_top_weighted_words,
    "logreg_score_loaded": q_logreg_score_loaded,
    "trips_from_csv": q_trips_from_csv,
    "corpus_size_from_text": q_corpus_size_from_text,
    "doc_lines_from_text": q_doc_lines_from_text,
    "links_from_text": q_links_from_text,
    "result_single_file": q_result_single_file,
    "result_many_files": q_result_many_files,
    "rejected_rows": q_rejected_rows,
    "drivers_per_vehicle_bitmaps": q_drivers_per_vehicle_bitmaps,
    "median_exact": q_median_exact,
    "vocabulary_bounded": q_vocabulary_bounded,
}
