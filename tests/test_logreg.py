"""Logistic regression: numpy check of one step, stop rule, scoring and metrics."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import logreg
from strata.session import Scratch

N_FEATURES = 4


def examples(spark, dense, labels):
    """Dense rows → long-form examples with the bias at position N_FEATURES."""
    rows = []
    for i, (x, y) in enumerate(zip(dense, labels)):
        for p, v in enumerate(x):
            if v != 0:
                rows.append((f"d{i}", int(y), p, float(v)))
        rows.append((f"d{i}", int(y), N_FEATURES, 1.0))
    return spark.createDataFrame(rows, "doc_id string, label int, pos bigint, value double")


def _data(seed=3, n=10):
    rng = np.random.default_rng(seed)
    dense = rng.random((n, N_FEATURES)) * (rng.random((n, N_FEATURES)) > 0.3)
    labels = (rng.random(n) > 0.5).astype(int)
    return dense, labels


def test_step_matches_numpy(spark):
    dense, labels = _data()
    ex = examples(spark, dense, labels)
    w = np.array([0.3, -0.2, 0.5, 0.1, -0.05])
    step = logreg.logreg_step(logreg.pack_examples(ex), w, N_FEATURES)
    x = np.hstack([dense, np.ones((len(dense), 1))])
    theta = x @ w
    grad = x.T @ (1 / (1 + np.exp(-theta)) - labels)
    loss = np.sum(-labels * theta + np.log(1 + np.exp(theta)))
    assert step.n == len(dense)
    assert np.allclose(step.gradient, grad, atol=1e-12)
    assert abs(step.loss - loss) < 1e-9


def test_full_batch_cost_falls_and_matches_numpy(spark):
    dense, labels = _data(5, 20)
    ex = examples(spark, dense, labels)
    fit = logreg.fit_logreg(ex, N_FEATURES, max_iteration=4, batch_size=None, tolerance=0.0, init="zeros")
    costs = [r["cost"] for r in fit.history.orderBy("iteration").collect()]
    assert len(costs) == 4 and all(a > b for a, b in zip(costs, costs[1:]))
    x = np.hstack([dense, np.ones((len(dense), 1))])
    w = np.zeros(N_FEATURES + 1)
    for _ in range(4):
        r = 1 / (1 + np.exp(-(x @ w))) - labels
        w = w - 0.6 * (x.T @ r / len(x) + 2 * 0.1 * w)
    assert np.allclose(fit.weight_vector, w, atol=1e-12)


def test_batch_larger_than_data_uses_all_rows(spark):
    dense, labels = _data(1, 10)
    ex = examples(spark, dense, labels)
    a = logreg.fit_logreg(ex, N_FEATURES, max_iteration=2, batch_size=100, tolerance=0.0)
    b = logreg.fit_logreg(ex, N_FEATURES, max_iteration=2, batch_size=None, tolerance=0.0)
    assert np.allclose(a.weight_vector, b.weight_vector)


def test_minibatch_samples_whole_documents(spark):
    dense, labels = _data(2, 200)
    ex = examples(spark, dense, labels)
    sample = logreg.sample_documents(ex, 0.3, 11)
    per_doc = sample.groupBy("doc_id").count().collect()
    full = dict((r["doc_id"], r["count"]) for r in ex.groupBy("doc_id").count().collect())
    assert 20 < len(per_doc) < 100
    assert all(full[r["doc_id"]] == r["count"] for r in per_doc)


def test_stop_rule_and_random_start(spark):
    dense, labels = _data(4, 30)
    ex = examples(spark, dense, labels)
    fit = logreg.fit_logreg(ex, N_FEATURES, max_iteration=50, tolerance=1e-3)
    assert fit.history.count() < 50
    assert np.allclose(
        logreg.initial_weights(N_FEATURES), np.random.RandomState(0).normal(0, 0.1, N_FEATURES + 1)
    )


def test_threshold_on_raw_score_and_metrics(spark):
    ex = spark.createDataFrame(
        [("a", 1, 0, 1.0), ("b", 0, 0, 0.4), ("c", 0, 1, 1.0), ("d", 1, 1, 0.2)],
        "doc_id string, label int, pos bigint, value double",
    )
    w = spark.createDataFrame([(0, 1.0), (1, 0.7)], "pos bigint, weight double")
    scored = logreg.score_logreg(ex, w, 1)
    pred = {r["doc_id"]: r["prediction"] for r in scored.collect()}
    assert pred == {"a": 1, "b": 0, "c": 1, "d": 0}  # 0.4 < 0.5 → 0
    m = logreg.classification_metrics(logreg.confusion_matrix(scored)).collect()[0]
    assert (m["tp"], m["tn"], m["fp"], m["fn"]) == (1, 1, 1, 1)
    assert m["precision"] == 0.5 and m["recall"] == 0.5 and m["f1"] == 0.5 and m["accuracy"] == 0.5


def test_no_positives_gives_zero_metrics(spark):
    scored = spark.createDataFrame([("a", 0, 0), ("b", 0, 0)], "doc_id string, label int, prediction int")
    m = logreg.classification_metrics(logreg.confusion_matrix(scored)).collect()[0]
    assert (m["precision"], m["recall"], m["f1"], m["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_top_weighted_words_excludes_bias(spark):
    w = spark.createDataFrame([(0, 0.1), (1, 0.9), (2, 0.5), (3, 0.5), (4, 5.0)], "pos bigint, weight double")
    vocab = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2), ("d", 3)], "word string, pos bigint")
    got = [r["word"] for r in logreg.top_weighted_words(w, vocab, N_FEATURES, 3).collect()]
    assert got == ["b", "c", "d"]


def test_label_by_substring(spark):
    docs = spark.createDataFrame([("xAUy",), ("abc",)], "doc_id string")
    got = {r["doc_id"]: r["label"] for r in logreg.label_by_substring(docs).collect()}
    assert got == {"xAUy": 1, "abc": 0}
    assert logreg.label_by_substring(docs).where(F.col("label") == 1).count() == 1


def test_empty_batches_are_skipped(spark):
    dense, labels = _data(6, 3)
    ex = examples(spark, dense, labels)
    # batch 1e-9 of the data: every batch is empty, nothing moves, nothing recorded
    fit = logreg.fit_logreg(ex, N_FEATURES, max_iteration=3, batch_size=1e-9, init="zeros")
    assert fit.history.count() == 0
    assert np.all(fit.weight_vector == 0)


def test_unknown_optimizer_is_rejected(spark):
    dense, labels = _data(6, 3)
    ex = examples(spark, dense, labels)
    try:
        logreg.fit_logreg(ex, N_FEATURES, optimizer="Adam")
    except ValueError:
        return
    raise AssertionError("optimizer not rejected")


def test_large_scores_stay_finite(spark):
    ex = spark.createDataFrame(
        [("a", 0, 0, 1.0), ("a", 0, 1, 1.0), ("b", 1, 0, -1.0), ("b", 1, 1, 1.0)], "doc_id string, label int, pos bigint, value double"
    )
    step = logreg.logreg_step(logreg.pack_examples(ex), np.array([1000.0, 0.0]), 1)
    assert (step.n, step.loss) == (2, 2000.0) and step.gradient.tolist() == [2.0, 0.0]


def test_repeated_ids_are_one_example(spark):
    tf = spark.createDataFrame([("AU1", 0, 0.5), ("AU1", 1, 0.5), ("2", 0, 1.0), ("3", 1, 1.0)], "doc_id string, pos bigint, tf double")
    labels = spark.createDataFrame([("AU1", 1), ("AU1", 1), ("2", 0), ("3", 0), ("3", 1), ("2", None)], "doc_id string, label int")
    by_table, by_id = logreg.logreg_examples(tf, labels, 2), logreg.logreg_examples_by_id(tf, 2)
    for ex, three in ((by_table, 1), (by_id, 0)):
        rows = sorted(tuple(r) for r in ex.collect())
        assert rows == sorted(
            [("AU1", 1, 0, 0.5), ("AU1", 1, 1, 0.5), ("AU1", 1, 2, 1.0), ("2", 0, 0, 1.0), ("2", 0, 2, 1.0), ("3", three, 1, 1.0), ("3", three, 2, 1.0)]
        )
        assert logreg.train_size(ex, 2).first()["n"] == 3
        score = logreg.score_logreg(ex, logreg.weights_frame(spark, np.full(3, 0.25)), 2)
        assert {r.doc_id: r.score for r in score.collect()}["AU1"] == 0.5


def test_batches_are_the_samples_of_their_iterations(spark):
    docs = spark.createDataFrame([(f"d{i}",) for i in range(300)], "doc_id string")
    rows = logreg.draw_batches(docs, 0.2, 5)
    for i in range(5):
        mine = {r.doc_id for r in rows.where(F.col("iteration") == i).collect()}
        assert mine == {r.doc_id for r in logreg.sample_documents(docs, 0.2, 1 + i).collect()} and 30 < len(mine) < 90


def test_a_stopped_fit_goes_on_where_it_was(spark, tmp_path, monkeypatch):
    dense, labels = _data(5, 30)
    ex = examples(spark, dense, labels)
    options = dict(max_iteration=5, batch_size=12, tolerance=0.0, init="normal")
    whole = logreg.fit_logreg(ex, N_FEATURES, **options)
    path, step, calls = str(tmp_path / "fit"), logreg.logreg_step, []

    def failing(*args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("driver lost")
        return step(*args)

    monkeypatch.setattr(logreg, "logreg_step", failing)
    with pytest.raises(RuntimeError):
        logreg.fit_logreg(ex, N_FEATURES, state=path, **options)
    # Resumed without the examples: the stored ones are used, two steps are not redone.
    resumed = logreg.fit_logreg(ex.limit(0), N_FEATURES, state=path, **options)
    assert len(calls) == 3 + 3
    assert np.allclose(resumed.weight_vector, whole.weight_vector, atol=1e-12)
    assert np.allclose([tuple(r) for r in resumed.history.collect()], [tuple(r) for r in whole.history.collect()], atol=1e-12)
    # A finished fit is only read; other settings are refused.
    again = logreg.fit_logreg(ex, N_FEATURES, state=path, **options)
    assert len(calls) == 6 and np.array_equal(again.weight_vector, resumed.weight_vector)
    with pytest.raises(ValueError):
        logreg.fit_logreg(ex, N_FEATURES, state=path, **(options | {"learning_rate": 0.1}))


def test_an_early_stop_is_kept(spark, tmp_path):
    dense, labels = _data(6, 12)
    ex, path = examples(spark, dense, labels), str(tmp_path / "fit")
    options = dict(max_iteration=6, batch_size=None, tolerance=1e9, init="zeros")
    fits = [logreg.fit_logreg(ex, N_FEATURES, state=path, **options) for _ in range(2)]
    assert [f.history.count() for f in fits] == [0, 0]
    assert np.array_equal(fits[0].weight_vector, fits[1].weight_vector)


def test_a_draft_of_a_lost_driver_is_not_read(spark, tmp_path):
    dense, labels = _data(7, 12)
    ex, path = examples(spark, dense, labels), tmp_path / "fit"
    options = dict(max_iteration=2, batch_size=None, tolerance=0.0, init="zeros")
    whole = logreg.fit_logreg(ex, N_FEATURES, **options)
    (path / "_draft-lost").mkdir(parents=True)
    (path / "_draft-lost" / "part-0.parquet").write_bytes(b"PAR1 broken")
    fit = logreg.fit_logreg(ex, N_FEATURES, state=str(path), **options)
    assert np.allclose(fit.weight_vector, whole.weight_vector, atol=1e-12)


@pytest.mark.parametrize("width", [1, 3, 40])
def test_the_tree_adds_up_to_the_plain_sums(spark, monkeypatch, width):
    monkeypatch.setattr(logreg, "branches", lambda _: width)
    dense, labels = _data(8, 60)
    packed = logreg.pack_examples(examples(spark, dense, labels)).repartition(7)
    w = np.linspace(-1, 1, N_FEATURES + 1)
    x = np.c_[dense, np.ones(len(dense))]
    sigma = 1 / (1 + np.exp(-(x @ w)))
    step = logreg.logreg_step(packed, w, N_FEATURES)
    assert step.n == 60 and np.allclose(step.gradient, x.T @ (sigma - labels))
    assert logreg.logreg_step(packed.limit(0), w, N_FEATURES).n == 0
    rows = logreg.gradient_sums(packed, w, N_FEATURES, None).collect()
    assert {r.pos for r in rows} == {*np.flatnonzero(x.any(axis=0)).tolist()}
    # One array per task, then one per branch: rows, not positions, are shuffled.
    partials = logreg.partial_sums(packed, w, N_FEATURES, width).collect()
    assert len(partials) <= 7 and all(len(r.grad) == N_FEATURES + 1 for r in partials)


def test_scoring_packed_documents_shuffles_nothing(spark):
    dense, labels = _data(9, 20)
    scratch = Scratch(spark)
    packed = scratch.table(logreg.pack_examples(examples(spark, dense, labels)))
    w = np.linspace(-1, 1, N_FEATURES + 1)
    scored = logreg.score_packed(packed, w, N_FEATURES)
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
    got = {r.doc_id: r.score for r in scored.collect()}
    assert np.allclose([got[f"d{i}"] for i in range(20)], np.c_[dense, np.ones(20)] @ w)
