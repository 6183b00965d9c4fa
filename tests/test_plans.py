"""Plan-shape tests: the scale properties the design relies on, read from the
executed physical plans (number of shuffles on the path from a scan to the root)."""

import numpy as np
from pyspark.sql import functions as F

from strata.operators import knn, logreg, text
from strata.operators.common import preview, top_n_per_group
from strata.plans import catalog
from strata.sources import driver_tables as views
from strata.sources import write_result

SF = "/root/testdata/sf0.001"


def _children(node):
    kids = [node.children().apply(i) for i in range(node.children().size())]
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        kids.append(node.executedPlan())
    if name in ("ShuffleQueryStage", "BroadcastQueryStage", "TableCacheQueryStage"):
        kids.append(node.plan())
    return kids


def _path_to(node, is_target, path=()):
    """Node names from the root down to the first node matching ``is_target``
    (not descending into cached relations)."""
    path = path + (node.nodeName(),)
    if is_target(node):
        return path
    if node.nodeName() == "InMemoryTableScan":
        return None
    for child in _children(node):
        found = _path_to(child, is_target, path)
        if found:
            return found
    return None


def _shuffles(df, is_target):
    df.write.format("noop").mode("overwrite").save()
    path = _path_to(df._jdf.queryExecution().executedPlan(), is_target)
    assert path is not None, "target scan not found"
    return sum(1 for name in path if name == "Exchange")


def _is_tf_scan(node):
    return node.nodeName().startswith("Scan parquet") and "tf#" in node.output().toString()


def _features(spark):
    return text.text_features(views.corpus_view(spark, SF), 2000)


def test_scoring_never_shuffles_tfidf(spark):
    f = _features(spark)
    qs = knn.query_vectors(views.query_texts_view(spark, SF), f.vocab, f.idf, f.scratch)
    for metric in ("cosine", "dot"):
        assert _shuffles(knn.score_documents(f.tfidf, qs, metric), _is_tf_scan) == 0


def test_knn_top_k_shuffles_best_rows_only(spark):
    """Once by (query, hash part), once by query, whatever k: the first stage ranks
    within the part, so no task gets more than k rows of a query and part."""
    f = _features(spark)
    qs = knn.query_vectors(views.query_texts_view(spark, SF), f.vocab, f.idf, f.scratch)
    for k in (10, 1000):
        best = knn.knn_neighbors(f.tfidf, qs, k)
        assert _shuffles(best, _is_tf_scan) == 2
        plan = best._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("_part") > 2


def test_previews_are_written_in_parallel(spark, tmp_path):
    f = _features(spark)
    write_result(preview(f.tf, "doc_id", 3), str(tmp_path / "tf"))
    assert spark.read.parquet(str(tmp_path / "tf")).select("doc_id").distinct().count() == 3
    plan = preview(f.tf, "doc_id", 3)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan


def test_training_step_shuffles_only_positions(spark):
    packed = logreg.pack_examples(catalog._examples(spark, SF, "train"))
    staged = packed.checkpoint(eager=True)
    sums = logreg.gradient_sums(staged, np.zeros(catalog.CLASSIFIER_K + 1), catalog.CLASSIFIER_K)
    is_scan = lambda n: n.nodeName().startswith("Scan ExistingRDD")
    assert _shuffles(sums, is_scan) == 1


def test_vocabulary_lookup_is_a_broadcast_join(spark):
    tokens = text.doc_tokens(views.corpus_view(spark, SF))
    vocab = text.build_vocabulary(text.word_counts(tokens), 100)
    positions = text.tokens_to_positions(tokens, vocab)
    plan = positions._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert positions.where(F.col("pos") >= 100).count() == 0


def test_restricted_neighbors_keep_two_shuffles(spark):
    f = _features(spark)
    qs = knn.query_vectors(views.query_texts_view(spark, SF), f.vocab, f.idf, f.scratch)
    links = views.links_view(spark, SF)
    assert _shuffles(knn.knn_neighbors(f.tfidf, qs, 10, "dot", restrict_to=links), _is_tf_scan) == 2


def test_the_best_of_a_group_alone_leave_a_task(spark):
    rows = spark.range(0, 40_000, 1, 4).selectExpr("id % 5 AS g", "id * 7919 % 40009 AS v")
    best = top_n_per_group(rows, "g", 3, [F.col("v").desc()])
    got = {(r.g, r["rank"]): r.v for r in best.collect()}
    want = {g: sorted((i * 7919 % 40009 for i in range(40_000) if i % 5 == g), reverse=True) for g in range(5)}
    assert got == {(g, k + 1): want[g][k] for g in want for k in range(3)}
    sent, todo = [], [best._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        todo += [node.plan()] if node.nodeName() == "ResultQueryStage" else _children(node)
        if node.nodeName() == "Exchange":
            sent.append(node.metrics().apply("shuffleRecordsWritten").value())
    assert sent and max(sent) <= 4 * 5 * 3


def test_cosine_sums_carry_no_norms(spark):
    f = _features(spark)
    qs = knn.query_vectors(views.query_texts_view(spark, SF), f.vocab, f.idf, f.scratch)
    scored = knn.score_documents(f.tfidf, qs, "cosine")
    assert "max(" not in scored._jdf.queryExecution().executedPlan().toString()
