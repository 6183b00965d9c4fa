"""Stored models: versions, checksums, another session."""

import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from strata.operators import logreg, model, text

K = 30


@pytest.fixture
def fitted(spark):
    docs = spark.createDataFrame(
        [(f"d{i}", " ".join(["apple pear", "stone rock"][i % 2].split() * (1 + i % 3)) + f" word{chr(97 + i)}", i % 2) for i in range(12)],
        "doc_id string, text string, label int",
    )
    vocab = text.build_vocabulary(text.word_counts(text.doc_tokens(docs)), K)
    examples = logreg.logreg_examples(text.featurize(docs, vocab), docs, K)
    fit = logreg.fit_logreg(examples, K, max_iteration=3, batch_size=None, init="zeros")
    return docs, vocab, fit.weights


def test_versions_count_up_and_the_last_one_is_loaded(spark, tmp_path, fitted):
    docs, vocab, weights = fitted
    path = str(tmp_path / "model")
    assert model.save_model(path, {"n_features": K}, vocab, weights) == "v000001"
    assert model.save_model(path, {"n_features": K, "note": "second"}, vocab) == "v000002"
    assert model.versions(spark, path) == ["v000001", "v000002"]
    last, first = model.load_model(spark, path), model.load_model(spark, path, "v000001")
    assert last.settings["note"] == "second" and last.weights is None and last.idf is None
    assert sorted(first.weights.collect()) == sorted(weights.collect())
    direct = logreg.score_logreg(logreg.logreg_examples(text.featurize(docs, vocab), docs, K), weights, K)
    key = lambda df: sorted((r.doc_id, r.label, round(r.score, 12), r.prediction) for r in df.collect())
    assert key(model.score_texts(first, docs, docs)) == key(direct)
    with pytest.raises(ValueError):
        model.load_model(spark, path, "v000009")
    with pytest.raises(ValueError):
        model.load_model(spark, str(tmp_path / "nothing"))


def test_a_changed_table_is_refused(spark, tmp_path, fitted):
    _, vocab, weights = fitted
    path = str(tmp_path / "model")
    version = model.save_model(path, {"n_features": K}, vocab, weights)
    changed = weights.withColumn("weight", F.col("weight") + F.when(F.col("pos") == 3, 1e-12).otherwise(0.0))
    changed.write.mode("overwrite").parquet(f"{path}/{version}/weights")
    with pytest.raises(ValueError, match="isn't what was saved"):
        model.load_model(spark, path)


def test_checksums_are_those_of_the_rows(spark):
    rows = spark.range(100).withColumn("v", F.col("id") % 7)
    assert model.checksum(rows) == model.checksum(rows.repartition(9).select("v", "id"))
    assert model.checksum(rows) != model.checksum(rows.unionByName(rows.limit(1)))
    assert model.checksum(rows.limit(0)) == (0, "0")


def test_another_session_scores_the_same(spark, tmp_path, fitted):
    docs, vocab, weights = fitted
    path, texts = str(tmp_path / "model"), str(tmp_path / "docs")
    model.save_model(path, {"n_features": K}, vocab, weights)
    docs.write.parquet(texts)
    want = sorted((r.doc_id, r.prediction, round(r.score, 9)) for r in model.score_texts(model.load_model(spark, path), docs, docs).collect())
    script = (
        "from strata.session import build_session\nfrom strata.operators import model\n"
        "spark = build_session('local[1]', 2)\n"
        f"docs = spark.read.parquet({texts!r})\n"
        f"rows = model.score_texts(model.load_model(spark, {path!r}), docs, docs).collect()\n"
        "print(sorted((r.doc_id, r.prediction, round(r.score, 9)) for r in rows))\n"
    )
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.strip().splitlines()[-1] == str(want)
