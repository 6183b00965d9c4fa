"""The training-data queries over the driver tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, lines, merkle, omh, packing, pieces, pii, quality, repair, rollup, runindex, topk, toxicity
from strata.llm.common import scratch, table

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
MULTI_BPE = "byte_bpe_multi_50k.tiktoken"


def tokenizer_path() -> str:
    return public_tokenizers.path(BYTE_BPE)


def op8_bpe_forced_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: id count and digests of both."""
    path = tokenizer_path()
    done = bpe.decode_documents(bpe.encode_documents(table(spark, sf_dir, "documents"), path), path)
    return done.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op1_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by compression distance."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.CUTOFF).cast("int").alias("predicted"),
    )


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and its class of near-duplicates."""
    return omh.near_duplicates(table(spark, sf_dir, "documents"))


def op3_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes that 50-byte strings of earlier ones cover."""
    found = runindex.repeated_spans(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_minimum_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_disclosure_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data of every document: counts of the base spans, and all spans."""
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    named = lambda spans, kind=None: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind) if kind else s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    counted = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    base, terms = named(F.col("spans")), named(F.col("terms"), "term")
    both = F.when((base != "") & (terms != ""), F.concat_ws(",", base, terms)).otherwise(F.concat(base, terms))
    return found.select("doc_id", *map(counted, pii.KINDS), F.sha2(base, 256).alias("base_sha256"), both.alias("spans"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest rows of every query row by integer inner product."""
    return topk.top_k(topk.quantised(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 50 == 0)


def op7_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals of the corpus after three batches and a repeated one: all
    documents come in under the first tokenizer version; all rows of a text but one, of
    the smallest doc_id (null last), are deleted; the other documents that aren't English
    are revised to the second version; the deletion is committed again, which changes nothing."""
    docs = table(spark, sf_dir, "documents")
    first, second = public_tokenizers.path(BYTE_BPE), public_tokenizers.path(MULTI_BPE)
    key = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("key")
    docs = docs.withColumn("doc_id", F.struct(key, "doc_id"))
    counts = scratch(rollup.count_tokens(docs, {"byte_bpe_50k": first}), "counts")
    row = F.struct(F.col("doc_id.doc_id").isNull(), "doc_id", "source", "lang", "tokenizer", "tokens")
    kept = scratch(counts.groupBy("doc_id.key").agg(F.min(row).alias("row")).select(*(f"row.{c}" for c in counts.columns)), "kept")
    foreign = ~F.col("lang").eqNullSafe("en")
    before = kept.where(foreign)
    second_counts = rollup.count_tokens(docs.where(foreign), {"byte_bpe_multi_50k": second})
    second_counts = second_counts.groupBy("doc_id.key").agg(F.min(F.struct("tokenizer", "tokens")).alias("new"))
    after = before.join(second_counts, F.col("doc_id.key") == F.col("key")).select("doc_id", "source", "lang", "new.tokenizer", "new.tokens")
    ledger = rollup.Ledger(spark)
    ledger.commit("insert", rollup.inserted(counts))
    ledger.commit("delete-copies", rollup.revised(counts, kept))
    ledger.commit("revise-foreign", rollup.revised(before, after))
    ledger.commit("delete-copies", rollup.revised(counts, kept))
    return ledger.totals()


def op9_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat an earlier three-line window."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    done = lines.deduplicate(docs)
    return done.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document judged by the base rules and the risk-controlled cutoffs."""
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.drop("lang")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, subroot and root, its proof's digest, and the root folded
    from the leaf after tampering."""
    rows = merkle.manifest(table(spark, sf_dir, "documents"))
    leaf = F.coalesce("changed", "leaf")
    rows = rows.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"),
        merkle.folded(leaf, F.col("path")).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_survivor_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation damaged by rule, its faults, its cheapest repair and a digest of it."""
    found = repair.audits(repair.damaged(table(spark, sf_dir, "conversations")))
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op13_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by merge rounds and decoded: id count and digests of both."""
    path = public_tokenizers.path(PIECE_BPE)
    done = pieces.decode_documents(pieces.encode_documents(table(spark, sf_dir, "documents"), path), path)
    return done.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_compression_toxicity": op1_compression_toxicity,
    "op2_order_minhash": op2_order_minhash,
    "op3_run_length_index": op3_run_length_index,
    "op4_minimum_bin_slack": op4_minimum_bin_slack,
    "op5_disclosure_pii": op5_disclosure_pii,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_token_rollups": op7_token_rollups,
    "op8_bpe_forced_boundaries": op8_bpe_forced_boundaries,
    "op9_line_windows": op9_line_windows,
    "op10_risk_controlled_rules": op10_risk_controlled_rules,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_survivor_viterbi": op12_survivor_viterbi,
    "op13_merge_rounds": op13_merge_rounds,
}

# Documents without the lines that a later three-line window covers; {docs} has
# doc_id and text, unique by doc_id.
LINES_SQL = """
    l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM {docs}),
    w AS (SELECT doc_id, i, lines[i] || chr(10) || lines[i + 1] || chr(10) || lines[i + 2] AS key
          FROM (SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS i FROM l)),
    f AS (SELECT key, min((doc_id, i)) AS first FROM w
          WHERE trim(key, ' ' || chr(10)) <> '' GROUP BY key HAVING count(*) > 1),
    c AS (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS i FROM w JOIN f USING (key) WHERE (doc_id, i) <> first),
    g AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id),
    kept AS (SELECT doc_id, len(lines) AS n_lines, coalesce(len(gone), 0) AS n_removed,
                 array_to_string(list_filter(lines, lambda x, i: NOT coalesce(list_contains(gone, i), false)), chr(10)) AS text
             FROM l LEFT JOIN g USING (doc_id))
"""



def merkle_levels(nodes: str, of: str, carried: str, levels: int) -> str:
    """CTEs that roll ``nodes`` (of, i, h, r: fold so far, s: siblings so far and the
    carried columns) up: {nodes}_1 ... with h the parents', r and s per leaf."""
    steps = []
    for k in range(1, levels + 1):
        before = nodes if k == 1 else f"{nodes}_{k - 1}"
        steps.append(f"""
    {nodes}_{k}k AS (SELECT {of} AS o, i // 16 AS p, list(h ORDER BY i) AS hs, sum(count(*)) OVER (PARTITION BY {of}) AS c
        FROM (SELECT DISTINCT {of}, i, h FROM {before}) GROUP BY {of}, i // 16),
    {nodes}_{k}s AS (SELECT b.*, hs, c, array_to_string(hs[1:(i % 16)::INT], '') AS l, array_to_string(hs[(i % 16 + 2)::INT:], '') AS g
        FROM {before} b JOIN {nodes}_{k}k ON o = {of} AND p = i // 16),
    {nodes}_{k} AS (SELECT {carried}, {of}, i // 16 AS i, CASE WHEN c > 1 THEN sha256(array_to_string(hs, '')) ELSE h END AS h,
            CASE WHEN c > 1 THEN sha256(l || r || g) ELSE r END AS r, CASE WHEN c > 1 THEN s || l || g ELSE s END AS s
        FROM {nodes}_{k}s)""")
    return ",".join(steps)


# The crc32 of a string of ASCII characters.
CRC32_SQL = """xor(4294967295::UBIGINT, list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(string_split({0}, ''), lambda x: ascii(x)::UBIGINT)),
        lambda crc, x: list_reduce(list_prepend(xor(crc, x), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
            lambda a, _: xor(a >> 1, 3988292384::UBIGINT * (a & 1::UBIGINT)))))"""
MERKLE_LEAF_SQL = "sha256(" + " || ".join(
    f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}")
) + ")"

ORACLE_SQL: dict[str, str] = {
    "op6_exact_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
                   FROM embeddings
                   WHERE embedding IS NOT NULL AND len(embedding) > 0
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id,
                  list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op10_risk_controlled_rules": r"""
        WITH w AS (SELECT doc_id, coalesce('l' || lang, '') AS stratum, coalesce(text, '') AS text,
                       regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM w),
        s AS (SELECT doc_id, i, words[i:i + 4] AS key
              FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
        r AS (SELECT DISTINCT doc_id, i + unnest(range(0, 5)) AS i
              FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, key) AS n FROM s) WHERE n > 1),
        c AS (SELECT doc_id, stratum, len(words)::BIGINT AS n_words,
                  coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
                  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                  len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                  coalesce(n, 0)::BIGINT AS n_repeat_words
              FROM w JOIN l USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM r GROUP BY doc_id) USING (doc_id)),
        v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
                  [('symbols', floor(1000 * n_symbols / greatest(n_words, 1))::BIGINT),
                   ('repeated', floor(1000 * n_repeat_words / greatest(n_words, 1))::BIGINT),
                   ('dup_lines', floor(1000 * n_dup_lines / greatest(n_lines, 1))::BIGINT),
                   ('long_words', floor(1000 * word_chars / greatest(n_words, 1))::BIGINT),
                   ('short_words', floor(1000 * n_words / greatest(word_chars, 1))::BIGINT)] AS vals FROM c),
        q AS (SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
        h AS (SELECT stratum, e[1] AS rule, e[2] AS value, sum(good::INT) AS good, sum((NOT good)::INT) AS bad
              FROM (SELECT stratum, good, unnest(vals) AS e
                    FROM (SELECT v.stratum, min(good) AS good, vals FROM v JOIN q USING (doc_id) JOIN w USING (doc_id)
                          WHERE NOT base_failed GROUP BY v.stratum, w.text, vals))
              GROUP BY ALL),
        a AS (SELECT stratum, rule, value, sum(good) OVER (PARTITION BY stratum, rule) AS n,
                  coalesce(sum(good) OVER x, 0) AS good_above, coalesce(sum(bad) OVER x, 0) AS bad_above FROM h
              WINDOW x AS (PARTITION BY stratum, rule ORDER BY value ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
        z AS (SELECT DISTINCT stratum, n FROM a),
        p AS (SELECT stratum, k, exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(0.004) + (n - k) * ln(0.996)) AS p
              FROM (SELECT stratum, n::DOUBLE AS n, unnest(range(0, ceil(n * 0.004)::BIGINT + 1)) AS k FROM z) WHERE k <= n),
        m AS (SELECT stratum, max(k) AS most
              FROM (SELECT stratum, k, sum(p) OVER (PARTITION BY stratum ORDER BY k) AS total FROM p)
              WHERE total <= 0.05 / (5 * (SELECT count(*) FROM z)) GROUP BY stratum),
        t AS (SELECT stratum, rule, min(value) AS cutoff FROM a JOIN m USING (stratum)
              WHERE good_above <= most AND bad_above > good_above GROUP BY ALL),
        b AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, stratum, unnest(vals) AS e FROM v) x
              JOIN t ON t.stratum = x.stratum AND t.rule = e[1] AND e[2] > cutoff)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM b) AS kept FROM v
    """,
    "op11_merkle_manifest": f"""
        WITH d AS (SELECT doc_id, coalesce('s' || source, '') AS source, {MERKLE_LEAF_SQL.format(text="text")} AS leaf,
                CASE WHEN {CRC32_SQL.format("doc_id::VARCHAR")} % 5 = 0
                    THEN {MERKLE_LEAF_SQL.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
                FROM documents),
            a AS (SELECT doc_id, leaf, leaf AS h, coalesce(changed, leaf) AS r, '' AS s, source, 1 AS one,
                row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
            {merkle_levels("a", "source", "doc_id, leaf, one", 6)},
            b AS (SELECT doc_id, leaf, h AS subroot, h, r, s, one, dense_rank() OVER (ORDER BY source) - 1 AS i FROM a_6),
            {merkle_levels("b", "one", "doc_id, leaf, subroot", 3)}
        SELECT doc_id, leaf, subroot, h AS root, sha256(s) AS proof_sha256, r AS folded_root, r = h AS verified FROM b_3
    """,
    "op9_line_windows": "WITH " + LINES_SQL.format(docs="documents") + """
        SELECT doc_id, n_lines, n_removed::BIGINT AS n_removed, sha256(text) AS kept_sha256 FROM kept
    """,
}
