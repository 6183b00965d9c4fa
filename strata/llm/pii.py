"""Personal data: pattern spans, and terms whose co-occurrence discloses them.

DataFrame functions only.  Base spans (email, ip, card, phone) come from patterns,
leftmost and without overlap within a kind.  Their values are the protected
entities.  A term in a document that holds an entity discloses it as far as the corpus
says so: with document counts n, PMI(c;t) = log2(N n(c,t) / (n(c) n(t))) against the entity's
information IC(c) = log2(N / n(c)).  A term whose PMI reaches a share GENERALISE of IC
is generalised to its kind of word, from a share REMOVE on it is removed; both need
MIN_CONTEXTS different surroundings (CONTEXT characters on either side) of the entity,
so that copies of one text prove nothing.  Such terms add spans of kind ``term`` wherever
they stand in a document that holds the entity; in documents without it they stay.

All counts are over whole texts of all documents: n(t) is the number of documents that
hold the term, n(c,t) of those that hold both, wherever.  Entities and terms are compared in lower case, numbers by
their digits.  Null and empty texts have no span.  Rows that share a doc_id are told
apart by their text; rows equal in both count once.  An empty table gives no row.

Patterns are written to run in linear time without deep recursion on texts of any
length: a match may only start where a longer one to its left is impossible.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import scratch

CONTEXT = 160  # characters on either side of an entity
MIN_CONTEXTS = 3
GENERALISE, REMOVE = 0.8, 0.95
TERM = r"\p{L}[\p{L}\p{N}]{2,}"
KINDS = ["email", "ip", "card", "phone"]
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Texts without these hold no match, which spares most texts the search.
TRIGGERS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
SPAN = "struct<start: int, end: int, value: string>"


def matches(text: Column, pattern: str) -> Column:
    """All matches of ``pattern`` (without groups) in order: start, end, value.

    The search goes on from the last match alone (\\G), else it would scan the rest of
    the text anew from each of its positions."""
    search = F.lit(rf"(?s)\G(.*?)({pattern})")
    gaps, values = (F.regexp_extract_all(text, search, F.lit(i)) for i in (1, 2))
    found = F.zip_with(gaps, values, lambda g, v: F.struct(F.char_length(g).alias("gap"), v.alias("value")))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.char_length(x["value"])
        span = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(acc["out"], span).alias("out"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
    return F.aggregate(found, none, add, lambda acc: acc["out"])


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(number: Column) -> Column:
    """Whether a string of digits has a Luhn check digit."""
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    each = F.transform(
        F.filter(F.split(F.reverse(number), ""), lambda c: c != ""),
        lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int")),
    )
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9][0-9]?)"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        number = digits(value)
        return F.char_length(number).between(13, 19) & passes_luhn(number)
    if kind == "phone":
        return F.char_length(digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """The base spans of a text by kind as listed, then start: kind, start, end, value."""
    none = F.array().cast("array<struct<kind: string, start: int, end: int, value: string>>")

    def of(kind: str) -> Column:
        kept = F.filter(matches(text, PATTERNS[kind]), lambda s: valid(kind, s["value"]))
        named = F.transform(kept, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"], s["end"], s["value"]))
        return F.when(text.rlike(TRIGGERS[kind]), named).otherwise(none)

    return F.concat(*(of(kind) for kind in KINDS))


def parts_between(text: Column, spans: Column) -> Column:
    """The text outside of all spans: start and text of every part, in order."""

    def add(acc: Column, s: Column) -> Column:
        part = F.struct(acc["at"].alias("start"), s["start"].alias("end"))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] > acc["at"], F.array_append(acc["out"], part)).otherwise(acc["out"]).alias("out"),
        )

    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int>>").alias("out"))
    last = lambda acc: F.array_append(acc["out"], F.struct(acc["at"].alias("start"), F.char_length(text).alias("end")))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"])))
    cuts = F.aggregate(ordered, none, add, last)
    return F.transform(cuts, lambda c: F.struct(c["start"], F.substring(text, c["start"] + 1, c["end"] - c["start"]).alias("text")))


def find_base(docs: DataFrame) -> DataFrame:
    """(doc_id, copy, spans, parts): every row's base spans with a hash of the text around
    each, and, where it has any, the text between them.  ``copy`` is a hash of the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("spans", base_spans(F.col("text")))

    def around(s: Column) -> Column:
        first = F.greatest(s["start"] - CONTEXT, F.lit(0))
        before = F.substring(F.col("text"), first + 1, s["start"] - first)
        after = F.substring(F.col("text"), s["end"] + 1, F.lit(CONTEXT))
        return F.struct(s["kind"], s["start"], s["end"], s["value"], F.xxhash64(before, after).alias("context"))

    parts = F.when(F.size("spans") > 0, parts_between(F.col("text"), F.col("spans"))).alias("parts")
    return scratch(rows.select("doc_id", F.xxhash64("text").alias("copy"), F.transform("spans", around).alias("spans"), parts), "spans")


def entities(base: DataFrame) -> DataFrame:
    """(doc_id, copy, entity, context): the entities of every row and what surrounds them."""
    s = F.col("s")
    value = F.when(s["kind"].isin("card", "phone"), digits(s["value"])).otherwise(F.lower(s["value"]))
    one = base.select("doc_id", "copy", F.explode("spans").alias("s"))
    return one.select("doc_id", "copy", F.concat(s["kind"], F.lit(":"), value).alias("entity"), s["context"].alias("context")).distinct()


def same_row(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """``a`` with the rows of ``b`` (whose keys are _doc and _copy) of its doc_id and text."""
    return a.join(b, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("copy") == F.col("_copy")), how)


class Shared(NamedTuple):
    """What the documents that hold a judged entity share with others."""

    held: DataFrame  # (_doc, _copy, entity, context, n, n_c, most), each once
    terms: DataFrame  # (doc_id, copy, term, n_t), each once


def shared_terms(docs: DataFrame, base: DataFrame) -> Shared:
    """The judged entities of the documents, and the words outside base spans of these documents,
    wherever they stand: kept apart, so a document costs the sum of both.  Left out are entities
    short of MIN_CONTEXTS, and terms in more documents than any n(c,t) <= n(c) could bring to GENERALISE."""
    n = docs.agg(F.count(F.lit(1)).alias("n"))
    held = entities(base)
    counted = held.groupBy("entity").agg(F.count_distinct("doc_id", "copy").alias("n_c"), F.count_distinct("context").alias("contexts"))
    counted = counted.where(F.col("contexts") >= MIN_CONTEXTS).drop("contexts").withColumn("n", n.scalar()).where("n > n_c")
    most = F.pow("n", F.lit(1 - GENERALISE)) * F.pow("n_c", F.lit(GENERALISE)) * (1 + 1e-9)
    keys = [F.col("doc_id").alias("_doc"), F.col("copy").alias("_copy")]
    judged = scratch(held.join(counted.withColumn("most", most), "entity").select(*keys, "entity", "context", "n", "n_c", "most"), "judged")

    words = F.transform("parts", lambda p: F.transform(F.regexp_extract_all(p["text"], F.lit(TERM), F.lit(0)), F.lower))
    rows = same_row(base.dropDuplicates(["doc_id", "copy"]), judged.select("_doc", "_copy").distinct(), "left_semi")
    rows = rows.select("doc_id", "copy", F.explode(F.array_distinct(F.flatten(words))).alias("term"))
    terms = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("term")
    n_t = docs.select(terms).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    n_t = n_t.where(F.col("n_t") <= judged.agg(F.max("most")).scalar())
    return Shared(judged, scratch(rows.join(n_t, "term").select("doc_id", "copy", "term", "n_t"), "terms"))


def disclosing(shared: Shared) -> DataFrame:
    """(entity, term, disclosure): pairs of at least GENERALISE, with the share of the
    entity's information that the term gives away.

    The documents of each pair are counted first, without the contexts; only pairs that
    disclose enough meet the contexts of their entity."""
    once = shared.held.select("_doc", "_copy", "entity", "n", "n_c", "most").distinct()
    both = same_row(shared.terms, once, "inner").where("n_t <= most")
    rows = both.groupBy("entity", "term", "n", "n_c", "n_t").agg(F.count(F.lit(1)).alias("n_ct"))
    information = F.log2(F.col("n") / F.col("n_c"))
    pmi = F.log2(F.col("n") * F.col("n_ct") / (F.col("n_c") * F.col("n_t")))
    share = F.when(information > 0, pmi / information).otherwise(F.lit(0.0))
    told = scratch(rows.select("entity", "term", share.alias("disclosure")).where(F.col("disclosure") >= GENERALISE), "told")
    contexts = holding(shared, told).select("entity", "term", "disclosure", "context").distinct()
    counted = contexts.groupBy("entity", "term", "disclosure").agg(F.count(F.lit(1)).alias("contexts"))
    return counted.where(F.col("contexts") >= MIN_CONTEXTS).drop("contexts")


def holding(shared: Shared, pairs: DataFrame) -> DataFrame:
    """The documents that hold both sides of the given (entity, term, disclosure) pairs,
    once for each context of the entity."""
    of_term = shared.terms.join(pairs, "term").withColumnRenamed("entity", "_entity")
    held = shared.held.select("_doc", "_copy", "entity", "context")
    return same_row(of_term, held, "inner").where(F.col("entity") == F.col("_entity"))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, copy, spans, terms): all spans of every row.  ``spans`` are the base
    ones by kind, then start; ``terms`` those of disclosing terms by start, with their
    disclosure.  Rows equal in doc_id and text come once for each."""
    base = find_base(docs)
    shared = shared_terms(docs, base)
    told = holding(shared, scratch(disclosing(shared), "disclosing"))
    told = told.groupBy("doc_id", "copy", "term").agg(F.max("disclosure").alias("disclosure"))
    told = told.groupBy(F.col("doc_id").alias("_doc"), F.col("copy").alias("_copy")).agg(
        F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("told")
    )

    def placed(p: Column) -> Column:
        found = F.transform(
            matches(p["text"], TERM),
            lambda t: F.struct(
                (t["start"] + p["start"]).alias("start"),
                (t["end"] + p["start"]).alias("end"),
                F.try_element_at(F.col("told"), F.lower(t["value"])).alias("disclosure"),
            ),
        )
        return F.filter(found, lambda t: t["disclosure"].isNotNull())

    none = F.array().cast("array<struct<start: int, end: int, disclosure: double>>")
    terms = F.when(F.col("told").isNotNull(), F.flatten(F.transform("parts", placed))).otherwise(none)
    return same_row(base, told, "left").select("doc_id", "copy", "spans", terms.alias("terms"))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` free of personal data: base spans become [EMAIL] and so on,
    disclosing terms become [NAME], [CODE] or [WORD] or go.  Other columns stay; rows
    whose text is null stay as they are."""
    found = find(docs).dropDuplicates(["doc_id", "copy"])
    found = found.where((F.size("spans") > 0) | (F.size("terms") > 0)).withColumnRenamed("doc_id", "id")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id"), text.alias("text"), F.xxhash64(text).alias("key"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("copy")), "left")
    base = F.transform("spans", lambda s: F.struct(s["start"], s["end"], F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("put")))

    def general(t: Column) -> Column:
        word = F.substring(F.col("text"), t["start"] + 1, t["end"] - t["start"])
        kind = F.when(word.rlike(r"\p{N}"), "[CODE]").when(word.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]")
        return F.struct(t["start"], t["end"], F.when(t["disclosure"] >= REMOVE, F.lit("")).otherwise(kind).alias("put"))

    def apart(acc: Column, s: Column) -> Column:  # what an earlier span covers is not covered again
        span = F.struct(F.greatest(s["start"], acc["at"]).alias("start"), s["end"], s["put"])
        return F.when(s["end"] <= acc["at"], acc).otherwise(
            F.struct(s["end"].alias("at"), F.array_append(acc["out"], span).alias("out"))
        )

    every = F.array_sort(F.concat(base, F.transform("terms", general)))
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int, put: string>>").alias("out"))
    cuts = F.aggregate(every, none, apart, lambda acc: acc["out"])
    joined = joined.withColumn("cuts", F.when(F.col("id").isNotNull() | F.col("copy").isNotNull(), cuts))
    before = lambda i: F.coalesce(F.get("cuts", i - 1)["end"], F.lit(0))
    pieces = F.transform(
        "cuts", lambda c, i: F.concat(F.substring(F.col("text"), before(i) + 1, c["start"] - before(i)), c["put"])
    )
    rest = F.substring(F.col("text"), F.element_at("cuts", -1)["end"] + 1, F.char_length("text"))
    new = F.when(F.col("cuts").isNull(), F.col("row.text")).otherwise(F.concat(F.array_join(pieces, ""), rest))
    return joined.select(*(new.alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
