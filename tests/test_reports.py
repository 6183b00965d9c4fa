"""File-based reports end to end, against the catalog queries on the same data."""

from pyspark.sql import functions as F

from strata.plans import catalog
from strata.plans.reports import classifier_report, corpus_report, trips_report
from strata.sources import driver_tables as views

SF = "/root/testdata/sf0.001"


_lines = views.as_doc_lines


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_trips_report(spark, tmp_path):
    views.trips_view(spark, SF).write.option("nullValue", "").csv(str(tmp_path / "trips"))
    trips_report(spark, str(tmp_path / "trips"), str(tmp_path / "out"))
    got = spark.read.parquet(str(tmp_path / "out/top_vehicles"))
    assert _rows(got, "vehicle", "drivers") == _rows(catalog.q_top_vehicles(spark, SF), "vehicle", "drivers")
    got = spark.read.parquet(str(tmp_path / "out/top_drivers"))
    want = catalog.q_top_drivers(spark, SF)
    assert [r["driver"] for r in got.collect()] == [r["driver"] for r in want.collect()]


def test_corpus_report(spark, tmp_path):
    corpus = views.corpus_view(spark, SF)
    _lines(corpus, F.col("doc_id"), F.col("text")).write.text(str(tmp_path / "pages"))
    views.link_lines_view(spark, SF).write.text(str(tmp_path / "links"))
    corpus_report(spark, str(tmp_path / "pages"), str(tmp_path / "links"),
                  views.query_texts_view(spark, SF), str(tmp_path / "out"))
    out = str(tmp_path / "out")
    tfidf = spark.read.parquet(f"{out}/tf_idf").select("doc_id", "pos", F.round("value", 9).alias("value"))
    assert _rows(tfidf, "doc_id", "pos", "value") == _rows(catalog.q_tf_idf(spark, SF), "doc_id", "pos", "value")
    votes = spark.read.parquet(f"{out}/knn_documents")
    want = catalog.q_knn_vote_documents(spark, SF)
    assert _rows(votes, "query_id", "category", "votes") == _rows(want, "query_id", "category", "votes")
    pairs = spark.read.parquet(f"{out}/knn_pairs")
    want = catalog.q_knn_vote_pairs(spark, SF)
    assert _rows(pairs, "query_id", "category", "votes") == _rows(want, "query_id", "category", "votes")
    top = spark.read.parquet(f"{out}/top_categories")
    assert _rows(top, "category", "count") == _rows(catalog.q_top_categories(spark, SF), "category", "count")
    assert spark.read.parquet(f"{out}/corpus_size").collect()[0]["n"] == corpus.count()
    top = spark.read.parquet(f"{out}/top_words")
    assert _rows(top, "word", "count") == _rows(catalog.q_top_words(spark, SF), "word", "count")


def test_classifier_report(spark, tmp_path):
    # Labels travel in the id, as the reference expects: 'AU' marks the positives.
    for split in ("train", "test"):
        docs = views.labelled_view(spark, SF, split)
        doc_id = F.concat(F.when(F.col("label") == 1, F.lit("AU")).otherwise(F.lit("")), F.col("doc_id"))
        _lines(docs, doc_id, F.col("text")).write.text(str(tmp_path / split))
    classifier_report(
        spark, str(tmp_path / "train"), str(tmp_path / "test"), str(tmp_path / "out"),
        max_iteration=catalog.FULLBATCH_STEPS, batch_size=None, tolerance=0.0, init="zeros",
    )
    got = spark.read.parquet(str(tmp_path / "out/metrics")).collect()[0]
    want = catalog.q_classification_metrics(spark, SF).collect()[0]
    assert (got["tp"], got["tn"], got["fp"], got["fn"]) == (want["tp"], want["tn"], want["fp"], want["fn"])
    assert round(got["f1"], 9) == want["f1"]
    lookups = spark.read.parquet(str(tmp_path / "out/lookups"))
    assert _rows(lookups, "word", "pos") == _rows(catalog.q_vocab_lookup(spark, SF), "word", "pos")
