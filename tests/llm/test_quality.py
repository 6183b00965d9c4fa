import math
import random
import re
from collections import Counter

import duckdb

from strata.llm import quality, queries
from strata.llm.common import scratch
from strata.llm.quality import F


def counts_by_force(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    repeated = {i + n for i, w in enumerate(windows) if often[w] > 1 for n in range(5)}
    inked = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(inked) - len(set(inked)), len(repeated))


def test_counts_equal_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " \n\t", "a", "a b c d e", "a b c d e a b c d e", "x " * 500, "one\n\n one\none\r\none", "  \x1c\x85 é\U0001f600 <|>", "a\x0bb\x0cc"]
    texts += [" ".join(rng.choice("abc") + rng.choice(["", "\n", "#"]) for _ in range(rng.randint(1, 60))) for _ in range(200)]
    texts += [" ".join(f"w{i}" for i in range(20_000)), " ".join(f"w{i % 7000}" for i in range(20_000))]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, words string")
    rows = quality.count_texts(docs, ["doc_id", "words"]).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in quality.COUNTS) == counts_by_force(texts[r.doc_id]), texts[r.doc_id]


def test_the_binomial_bound_is_exact(spark):
    for rate, error in ((0.02, 0.01), (0.004, 0.0025)):
        sizes = [1, 50, 300, 1000, 5000]
        df = spark.createDataFrame([(n,) for n in sizes], "n long")
        got = {r.n: r.k for r in df.select("n", quality.most_rejections(F.col("n"), rate, F.lit(error)).alias("k")).collect()}
        for n in sizes:
            total, k = 0.0, -1
            for j in range(n + 1):
                total += math.comb(n, j) * rate**j * (1 - rate) ** (n - j)
                if total > error:
                    break
                k = j
            assert got[n] == k


def made(spark, n=3000):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        bad = i % 10 == 0
        words = [rng.choice("abcdefgh") * rng.randint(2, 6) + str(rng.random())[2:5] for _ in range(40)]
        if bad and i % 20 == 0:
            words = [w + "###" for w in words]
        rows.append((i, " ".join(words), "en" if i % 3 else None, 1))
        labels.append((i, int(not bad)))
    rows += [(n, None, "en", 1), (n + 1, "", "fr", 1), (n + 2, " ".join(map(str, range(50))) + " ### " * 3, "fr", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, cutoff int")
    return docs, spark.createDataFrame(labels + [(None, 1), (5, None), (6, 1), (10**9, 0)], "doc_id long, quality int")


def test_rules_reject_bad_documents_and_keep_to_the_risk(spark):
    docs, labels = made(spark)
    kept = {r.doc_id: r.kept for r in quality.judge(docs, labels, risk=0.05).collect()}
    assert len(kept) == 3003
    assert not any(kept[i] for i in range(0, 3000, 20))
    good = [i for i in range(3000) if i % 10]
    assert sum(not kept[i] for i in good) <= 0.05 * len(good)
    assert not kept[3000] and not kept[3001] and kept[3002]


def test_without_labels_the_base_rules_decide(spark):
    docs, labels = made(spark, 40)
    for none in (labels.limit(0), labels.where("quality = 0"), labels.limit(3)):
        rows = quality.judge(docs, none).collect()
        assert len(rows) == 43 and all(r.kept == (not r.base_failed) for r in rows)
    assert quality.judge(docs.limit(0), labels).collect() == []
    twice = quality.judge(docs.union(docs), labels)
    assert twice.count() == 86


def test_cutoffs_and_ties_equal_the_sql(spark, tmp_path):
    rng, rows, labels = random.Random(3), [], []
    for i in range(4500):
        bad = i % 9 == 0
        signs = rng.choice([1, 2, 3, 6]) if bad else int(rng.random() < 0.2) + int(rng.random() < 0.001)
        words = [rng.choice("abcdefgh") * rng.randint(2, 6) + str(rng.random())[2:6] for _ in range(rng.choice([20, 30, 40]))]
        rows.append((i, " ".join(words + ["x#" + str(k) for k in range(signs)]), "en" if i < 4200 else None))
        labels.append((i, int(not bad)))
    rows += [(5000 + i, rows[2][1], "en") for i in range(800)]  # one text, one vote
    labels += [(5000 + i, int(i != 7)) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    name = "op10_risk_controlled_rules"
    got = queries.QUERIES[name](spark, str(tmp_path)).toPandas()
    want = con.sql(queries.ORACLE_SQL[name]).df()[list(got.columns)]
    tuples = lambda df: sorted(df.itertuples(index=False, name=None))
    assert tuples(got) == tuples(want)
    assert (~got.kept & ~got.base_failed).sum() > 100

    texts = docs.withColumn("same", F.sha2("text", 256))
    counted = scratch(quality.count_texts(texts, ["doc_id", "lang", "same"]), "counts")
    chosen = {(r.stratum, r.rule): r for r in quality.cutoffs(counted, spark.read.parquet(str(tmp_path / "labels.parquet"))).collect()}
    found = chosen["len", "symbols"]
    good = {t for i, t, l in rows if l == "en" and (i >= 5000 or i % 9)} - {rows[2][1]}
    assert found.n_good == len(good) and found.good_above <= found.most
    at_cutoff = counted.where("lang = 'en'").withColumn("v", quality.rules()["symbols"]).where(F.col("v") == found.cutoff)
    kept = {r.doc_id for r in quality.judge(docs, spark.read.parquet(str(tmp_path / "labels.parquet"))).where("kept").collect()}
    tied = [r.doc_id for r in at_cutoff.collect()]
    assert len(tied) > 1 and any(i in kept for i in tied)
