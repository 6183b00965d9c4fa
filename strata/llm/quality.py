"""Quality rules with risk-controlled thresholds, DataFrame functions only.

Base rules reject a text of fewer than 10 words, or of which repeated five-word windows
cover over 20 % of the words.  On top, five statistics get a cutoff per stratum
(language) from labelled documents: a rule rejects a text whose statistic lies above
its cutoff.  With n good documents held out in a stratum, a cutoff may reject k of them
only if the exact binomial probability of seeing k or fewer at a true rate RISK / R is
at most DELTA / (R S): Clopper-Pearson's upper bound, corrected for the R rules and S
strata (Bonferroni).  So, with probability 1 - DELTA, no stratum loses more than RISK of
its good documents to all its rules together.  The cutoff is the lowest that keeps to
that; where there are too few good documents for any, the rule rejects nothing.  A rule
also stays out of use in a stratum where the documents it rejects aren't mostly bad.

All labelled documents with a quality count, reduced to one row per statistic value.
The bound needs independent draws, so equal texts of a stratum are one vote, a good one
if all of them are good.
Null texts have no words and fail the base rules.  Strata are told apart null-safely;
documents of a stratum without labels meet the base rules alone.  Of repeated labels
the least quality counts; repeated rows are judged each, ties at a cutoff are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import scratch

RISK, DELTA = 0.02, 0.05
SHINGLE = 5
MIN_WORDS, MAX_REPEATED_PERCENT = 10, 20
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
STEPS = 1000  # a statistic is a count of 1/1000 steps, hence its table of values is small
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def rules() -> dict[str, Column]:
    """The statistics, high is bad, in steps."""
    per = lambda a, b: F.floor(STEPS * F.col(a) / F.greatest(F.col(b), F.lit(1))).cast("long")
    return {
        "symbols": per("n_symbols", "n_words"),
        "repeated": per("n_repeat_words", "n_words"),
        "dup_lines": per("n_dup_lines", "n_lines"),
        "long_words": per("word_chars", "n_words"),
        "short_words": per("n_words", "word_chars"),
    }


def count_texts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` and the counts of every text, one narrow pass.

    Each array is a column of its own, as lambdas would compute an expression anew for
    every element.  Only texts with a repeated window sort their windows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    row = F.struct(*keep).alias("row")
    rows = docs.select(row, text.alias("text")).select("row", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    inked = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD))
    less = lambda signs: F.char_length(F.translate(F.col("text"), signs, ""))
    rows = rows.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        less(BLANKS).cast("long").alias("word_chars"),
        (F.char_length("text") - less(SYMBOLS)).cast("long").alias("n_symbols"),
        inked.alias("inked"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    window = lambda i: F.xxhash64(*(F.get("hashes", i + n) for n in range(SHINGLE)))
    starts = F.sequence(F.lit(0), F.size("hashes") - SHINGLE)
    rows = rows.withColumn("windows", F.when(F.size("hashes") > SHINGLE, F.transform(starts, window)).otherwise(F.array().cast("array<long>")))
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("placed", F.when(again, placed))
    same = lambda i, j: F.coalesce(F.get("placed", i)["h"] == F.get("placed", j)["h"], F.lit(False))
    every = F.filter(F.sequence(F.lit(0), F.size("placed") - 1), lambda i: same(i, i - 1) | same(i, i + 1))
    rows = rows.withColumn("starts", F.array_sort(F.transform(every, lambda i: F.get("placed", i)["i"])))
    step = lambda i: F.least(F.coalesce(F.get("starts", i + 1) - F.get("starts", i), F.lit(SHINGLE)), F.lit(SHINGLE))
    repeated = F.aggregate(F.sequence(F.lit(0), F.size("starts") - 1), F.lit(0), lambda a, i: a + step(i))
    return rows.select(
        *(F.col(f"row.`{c}`").alias(c) for c in keep),
        "n_words",
        "word_chars",
        "n_symbols",
        F.size("inked").cast("long").alias("n_lines"),
        (F.size("inked") - F.size(F.array_distinct("inked"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("placed").isNotNull(), repeated).otherwise(0).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def most_rejections(n: Column, rate: float, error: Column) -> Column:
    """The most rejections k among ``n`` for which the binomial probability of k or
    fewer at ``rate`` is at most ``error``; -1 if there is no such k."""
    odds = math.log(rate) - math.log1p(-rate)

    def add(acc: Column, j: Column) -> Column:
        term = F.when(j == 0, n * math.log1p(-rate)).otherwise(acc["term"] + F.log((n - j + 1) / F.greatest(j, F.lit(1))) + odds)
        total = acc["total"] + F.exp(term)
        return F.struct(term.alias("term"), total.alias("total"), F.when(total <= error, j).otherwise(acc["k"]).alias("k"))

    none = F.struct(F.lit(0.0).alias("term"), F.lit(0.0).alias("total"), F.lit(-1).cast("long").alias("k"))
    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.ceil(n * rate)), none, add, lambda acc: acc["k"])


def stratum() -> Column:
    """A key that no null is: '' for the null language, else 'l' and its name."""
    return F.coalesce(F.concat(F.lit("l"), F.col("lang")), F.lit(""))


def cutoffs(counted: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff, most, n_good, good_above, bad_above): the rules in use.
    ``counted`` is read more than once, so it should be stored; ``same`` tells its texts apart."""
    known = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))
    held = counted.where(~base_failed()).join(known, "doc_id").withColumn("stratum", stratum())
    alike = [F.min(c).alias(c) for c in [*COUNTS, "n_lines"]]  # equal in equal texts
    held = held.groupBy("stratum", "same").agg(F.min("good").alias("good"), *alike)
    names = rules()
    entries = F.array(*(F.struct(F.lit(k).alias("rule"), v.alias("value")) for k, v in names.items()))
    values = held.select("stratum", "good", F.explode(entries).alias("e"))
    table = values.groupBy("stratum", "e.rule", "e.value").agg(
        F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad")
    )
    above = Window.partitionBy("stratum", "rule").orderBy("value").rowsBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy("stratum", "rule")
    table = table.select(
        "stratum",
        "rule",
        "value",
        F.sum("good").over(whole).alias("n_good"),
        F.coalesce(F.sum("good").over(above), F.lit(0)).alias("good_above"),
        F.coalesce(F.sum("bad").over(above), F.lit(0)).alias("bad_above"),
    )
    sizes = table.select("stratum", "n_good").distinct()
    error = F.lit(delta / (len(names) * max(1, sizes.count())))
    most = sizes.select("stratum", most_rejections(F.col("n_good"), risk / len(names), error).alias("most"))
    fit = table.join(most, "stratum").where((F.col("good_above") <= F.col("most")) & (F.col("bad_above") > F.col("good_above")))
    lowest = F.min_by(F.struct("value", "most", "n_good", "good_above", "bad_above"), "value").alias("c")
    return fit.groupBy("stratum", "rule").agg(lowest).select("stratum", "rule", F.col("c.value").alias("cutoff"), "c.most", "c.n_good", "c.good_above", "c.bad_above")


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(doc_id, lang, counts, base_failed, kept) of every row of ``docs``."""
    texts = docs.select("doc_id", "lang", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("same"))
    counted = scratch(count_texts(texts, ["doc_id", "lang", "same"]), "counts")
    chosen = scratch(cutoffs(counted, labels, risk, delta), "cutoffs")  # a row per language and rule at most
    entry = F.struct(F.concat_ws(":", "rule", "stratum"), "cutoff")
    limits = chosen.agg(F.map_from_entries(F.collect_list(entry)).alias("m")).scalar()
    within = F.lit(True)
    for name, value in rules().items():
        limit = F.try_element_at("limits", F.concat_ws(":", F.lit(name), "stratum"))
        within &= F.coalesce(value <= limit, F.lit(True))
    rows = counted.withColumn("limits", limits).withColumn("stratum", stratum()).withColumn("base_failed", base_failed())
    return rows.select("doc_id", "lang", *COUNTS, "base_failed", (~F.col("base_failed") & within).alias("kept"))
