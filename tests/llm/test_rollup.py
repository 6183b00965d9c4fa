from collections import Counter

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import bpe, queries, rollup

SF = "/root/testdata/sf0.001"


def totals(df):
    return {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in df.collect()}


def test_query_equals_brute_force(spark):
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ranks, _ = bpe._read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    second = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs, tokens, seen = Counter(), Counter(), set()
    for d in sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda d: d.doc_id):
        text = d.text or ""
        if text in seen:
            continue
        seen.add(text)
        if d.lang == "en":
            key, n = (d.source, d.lang, "byte_bpe_50k"), len(first.encode(text, add_special_tokens=False).ids)
        else:
            key, n = (d.source, d.lang, "byte_bpe_multi_50k"), len(second.encode_ordinary(text))
        docs[key] += 1
        tokens[key] += n
    assert totals(queries.op7_token_rollups(spark, SF)) == {k: (docs[k], tokens[k]) for k in docs}


def test_batches_commit_once_and_cancel(spark):
    counts = spark.createDataFrame(
        [(1, "a", "en", "v", 5), (2, None, None, "v", 7), (3, "a", "en", "v", None), (1, "a", "en", "v", 5)],
        "doc_id long, source string, lang string, tokenizer string, tokens long",
    ).withColumn("documents", rollup.F.lit("clash"))
    ledger = rollup.Ledger(spark)
    ledger.commit("1", rollup.inserted(counts))
    ledger.commit("1", rollup.inserted(counts))
    ledger.commit("0", rollup.inserted(counts.limit(0)))
    assert totals(ledger.totals()) == {("a", "en", "v"): (2, 10), (None, None, "v"): (1, 7)}
    ledger.commit("2", rollup.deleted(counts.where("doc_id = 2")))
    after = counts.where("doc_id = 1").withColumn("tokens", rollup.F.lit(6).cast("long"))
    ledger.commit("3", rollup.revised(counts.where("doc_id = 1"), after))
    assert totals(ledger.totals()) == {("a", "en", "v"): (2, 12)}
    assert totals(ledger.totals(rollup.F.col("batch_id") == "1"))[("a", "en", "v")] == (2, 10)
    again = rollup.Ledger(spark, ledger.path)
    assert again.batches().select("batch_id").distinct().count() == 3


def test_a_batch_without_changes_on_a_new_ledger(spark):
    none = spark.createDataFrame([], "doc_id long, source string, lang string, tokenizer string, tokens long")
    ledger = rollup.Ledger(spark)
    ledger.commit("0", rollup.inserted(none))
    assert ledger.totals().collect() == []


def test_one_row_of_every_text_stays_whatever_its_id(spark, tmp_path):
    rows = [(None, "alone", "en", "s"), (1, "twice", "en", "s"), (1, "twice", "en", "s"), (1, "other", "en", "s"), (2, "twice", "en", "s")]
    rows += [(None, "none", "en", "s"), (None, "none", "en", "s"), (3, "none", "en", "t"), (4, "vier", "de", "s"), (4, "vier", "de", "s"), (None, None, None, "s")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {k: n for k, (n, _) in totals(queries.op7_token_rollups(spark, str(tmp_path))).items()}
    one, two = "byte_bpe_50k", "byte_bpe_multi_50k"
    assert got == {("s", "en", one): 3, ("t", "en", one): 1, ("s", "de", two): 1, ("s", None, two): 1}


def test_a_batch_is_replaced_by_an_empty_one_and_by_another(spark):
    schema = "source string, lang string, tokenizer string, tokens long, sign int"
    one = spark.createDataFrame([("a", "en", "t", 5, 1)], schema)
    other = spark.createDataFrame([("b", None, "t", 7, 1), ("b", None, "t", 1, 1)], schema)
    ledger = rollup.Ledger(spark)
    assert ledger.totals().collect() == []
    ledger.commit("1", one)
    ledger.commit("x/ y=2", other)
    assert totals(ledger.totals()) == {("a", "en", "t"): (1, 5), ("b", None, "t"): (2, 8)}
    ledger.commit("1", one.limit(0))
    assert totals(ledger.totals()) == {("b", None, "t"): (2, 8)}
    ledger.commit("1", other)
    ledger.commit("1", other)
    assert totals(ledger.totals()) == {("b", None, "t"): (4, 16)}
    assert totals(ledger.totals(F.col("batch_id") == "1")) == {("b", None, "t"): (2, 8)}
    assert len(ledger.last()) == 2


def test_a_draft_of_a_lost_driver_counts_nothing(spark, tmp_path):
    schema = "source string, lang string, tokenizer string, tokens long, sign int"
    (tmp_path / "_draft-lost").mkdir()
    (tmp_path / "_draft-lost" / "part-0.parquet").write_bytes(b"broken")
    ledger = rollup.Ledger(spark, str(tmp_path))
    ledger.commit("1", spark.createDataFrame([("a", "en", "t", 5, 1)], schema))
    assert totals(ledger.totals()) == {("a", "en", "t"): (1, 5)}
