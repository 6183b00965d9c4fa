"""Readers, tokenizer, vocabulary and TF-IDF on hand-made inputs."""

import math

from pyspark.sql import functions as F

from strata.functions.text import tokenize
from strata.operators import links, text
from strata.sources import corpus_size, parse_category_links, parse_doc_lines


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_doc_lines_parse_and_bad_line_is_dropped_but_counted(spark):
    df = lines(spark, [
        '<doc id="12" url="http://x/y" title="t">Hello world</doc>',
        "id url= nothing",
        '<doc id="7" url="u">ab</doc>',
        '<doc id="8" url="u">xy',  # body shorter than the 6 closing characters
    ])
    parsed = sorted((r["doc_id"], r["text"]) for r in parse_doc_lines(df).collect())
    assert parsed == [("12", "Hello world"), ("7", "ab"), ("8", "")]
    assert corpus_size(df).collect()[0]["n"] == 4


def test_category_link_split_at_every_comma(spark):
    df = lines(spark, ['"1","Foo, bar"', '"2","Baz"', "no comma here"])
    got = sorted((r["doc_id"], r["category"]) for r in parse_category_links(df).collect())
    assert got == [("1", "Foo"), ("2", "Baz")]


def test_tokenizer_replaces_before_lowercasing(spark):
    df = spark.createDataFrame([("aKbiİc  Déjà-vu 42 ",), ("123 !!",)], "text string")
    got = [r[0] for r in df.select(tokenize("text")).collect()]
    assert got == [["a", "bi", "c", "d", "j", "vu"], []]


def test_vocabulary_smaller_than_k(spark):
    docs = spark.createDataFrame([("1", "b a b c b a")], "doc_id string, text string")
    vocab = text.build_vocabulary(text.word_counts(text.doc_tokens(docs)), 10)
    assert [(r["word"], r["pos"]) for r in vocab.orderBy("pos").collect()] == [
        ("b", 0), ("a", 1), ("c", 2)
    ]


def test_vocab_lookup_missing_word_is_minus_one(spark):
    docs = spark.createDataFrame([("1", "x y y")], "doc_id string, text string")
    vocab = text.build_vocabulary(text.word_counts(text.doc_tokens(docs)), 10)
    words = spark.createDataFrame([("y",), ("zzz",)], "word string")
    got = dict((r["word"], r["pos"]) for r in text.vocab_lookup(vocab, words).collect())
    assert got == {"y": 0, "zzz": -1}


def test_term_frequency_and_out_of_vocabulary_documents(spark):
    docs = spark.createDataFrame(
        [("1", "a a b"), ("2", "a b"), ("3", "zzz")], "doc_id string, text string"
    )
    # K = 2: 'zzz' is out of the vocabulary, so document 3 has no vector.
    f = text.text_features(docs, 2)
    tf = {(r["doc_id"], r["pos"]): r["tf"] for r in f.tf.collect()}
    assert tf == {("1", 0): 2 / 3, ("1", 1): 1 / 3, ("2", 0): 0.5, ("2", 1): 0.5}
    idf = {r["pos"]: r["idf"] for r in f.idf.collect()}
    assert idf == {0: math.log(3 / 2), 1: math.log(3 / 2)}
    assert {r["doc_id"] for r in f.tfidf.collect()} == {"1", "2"}


def test_equal_ids_merge_into_one_vector(spark):
    docs = spark.createDataFrame([("1", "a"), ("1", "b b")], "doc_id string, text string")
    f = text.text_features(docs, 5, stored=False)
    tf = {(r["doc_id"], r["pos"]): r["tf"] for r in f.tf.collect()}
    assert tf == {("1", 0): 2 / 3, ("1", 1): 1 / 3}
    # N counts both lines: idf = ln(2 / 1)
    assert {round(r["idf"], 12) for r in f.idf.collect()} == {round(math.log(2), 12)}


def test_tf_sums_to_one_per_document(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        F.col("doc_id").cast("string").alias("doc_id"), "text"
    )
    f = text.text_features(docs, 500)
    sums = f.tf.groupBy("doc_id").agg(F.sum("tf").alias("s")).collect()
    assert sums and all(abs(r["s"] - 1.0) < 1e-9 for r in sums)
    assert f.tfidf.where(F.col("value") < 0).count() == 0


def test_link_statistics(spark):
    df = spark.createDataFrame(
        [("1", "A"), ("1", "B"), ("2", "A"), ("3", "A"), ("3", "C"), ("3", "C")],
        "doc_id string, category string",
    )
    per_doc = links.categories_per_doc(df)
    d = links.describe_counts(per_doc).collect()[0]
    assert (d["n"], d["min"], d["max"]) == (3, 1, 3)
    assert abs(d["mean"] - 2.0) < 1e-12 and abs(d["stddev"] - 1.0) < 1e-12
    assert links.median_count(per_doc).collect()[0]["median"] == 2
    top = links.top_categories(df, 2).collect()
    assert [(r["category"], r["count"]) for r in top] == [("A", 3), ("C", 2)]


def test_table_storage_keeps_doc_partitioning(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        F.col("doc_id").cast("string").alias("doc_id"), "text"
    )
    lazy = text.text_features(docs, 300, stored=False)
    table = text.text_features(docs, 300)
    assert sorted(table.tfidf.collect()) == sorted(lazy.tfidf.collect())
    # TF read back from the bucketed table: a per-document aggregate needs no exchange.
    plan = table.tf.groupBy("doc_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_vocabulary_cut_with_ties_and_any_k(spark):
    rows = [(w, c) for w, c in zip("abcdefghij", [9, 5, 5, 5, 5, 2, 2, 1, 1, 1])]
    counts = spark.createDataFrame(rows, "word string, count bigint")
    for k in (1, 3, 5, 7, 8, 10, 6_000_000):
        got = [(r["word"], r["pos"]) for r in text.build_vocabulary(counts, k).orderBy("pos").collect()]
        assert got == [(w, i) for i, (w, _) in enumerate(rows[:k])]
    assert text.build_vocabulary(counts.limit(0), 3).collect() == []
    tokens = counts.select(F.lit("d").alias("doc_id"), "word")
    assert text.tokens_to_positions(tokens, text.build_vocabulary(counts, 6_000_000)).count() == 10
