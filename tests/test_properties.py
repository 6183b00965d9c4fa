"""Column expressions on generated strings (invariants) and on hand-worked lines."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.text import doc_line_id, doc_line_text, is_doc_line, tokenize

# Letters, digits, punctuation, whitespace and non-ASCII letters that change
# under lower-casing (Kelvin sign, dotted I, sharp s, Greek).
ALPHABET = st.sampled_from(list("abcXYZ09 \t\n.,'\"<>=/-_") + ["K", "İ", "ß", "Σ", "é"])
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=30)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=TEXTS)
def test_tokens_are_ascii_words_in_order(spark, texts):
    """Invariants: lower-case ASCII words; gluing texts with a blank concatenates their
    tokens; tokenizing the tokens again changes nothing; no letter is lost."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, " ".join(texts)])], "i int, text string")
    df = df.select("i", "text", tokenize("text").alias("t")).select("i", "text", "t", tokenize(F.concat_ws(" ", "t")).alias("again"))
    got = {r["i"]: r for r in df.collect()}
    glued = []
    for i, t in enumerate(texts):
        words = got[i]["t"]
        assert words == got[i]["again"]
        assert all(w and w.isascii() and w.isalpha() and w.islower() for w in words)
        assert sum(map(len, words)) == sum(c.isascii() and c.isalpha() for c in t)
        glued += words
    assert got[len(texts)]["t"] == glued


# Hand-worked lines: (line, id, text), None where the line is dropped.
DOC_LINES = [
    ('<doc id="12" url="http://x" title="t">Hello</doc>', "12", "Hello"),
    ('<doc id="" url="u">ab</doc>', "", "ab"),
    ('<doc id="7" url="u">', "7", ""),
    ('<doc id="7" url="u">abc', "7", ""),
    ('<doc id="7" url="u">abcdefgh', "7", "ab"),
    ('<doc id="8" url="u">a "> b</doc>', "8", 'a "> b'),
    ('x id="9" url="u" ">y</doc>', "9", "y"),
    ('<doc id="1" url="u" title="t"', None, None),
    ('<doc id="1" title="t">x</doc>', None, None),
    ("", None, None),
]


def test_doc_lines_by_hand(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _, _) in enumerate(DOC_LINES)], "i int, value string")
    rows = df.select(
        "i", is_doc_line("value").alias("ok"), doc_line_id("value").alias("id"), doc_line_text("value").alias("t")
    ).collect()
    got = {r["i"]: ((r["id"], r["t"]) if r["ok"] else (None, None)) for r in rows}
    assert [got[i] for i in range(len(DOC_LINES))] == [(d, t) for _, d, t in DOC_LINES]


NUMBERS = st.one_of(
    st.floats(allow_nan=True, allow_infinity=True, width=32).map(str),
    st.sampled_from(["", "abc", "nan", "NaN", "inf", "-inf", " 61 ", "60", "60.0", "0.1", "0.10", "0.11", "1e2", ".5", "5."]),
    st.none(),
)


def spec_clean(fields):
    """The reference rule with its repairs: every field a float, NaN fails, strict bounds."""
    values = []
    for v in fields:
        try:
            x = float(v)
        except (TypeError, ValueError):
            return None
        if x != x:
            return None
        values.append(x)
    duration, distance, fare, total = values
    ok = duration > 60 and distance > 0.10 and fare > 0.10 and total > 0.10
    return tuple(values) if ok else None


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(NUMBERS, NUMBERS, NUMBERS, NUMBERS), min_size=1, max_size=40))
def test_trip_cleaning_matches_spec(spark, rows):
    from strata.operators.trips import clean_trips

    schema = ", ".join(f"c{i} string" for i in range(17))
    records = []
    for i, (d, s, f, t) in enumerate(rows):
        r = [""] * 17
        r[0], r[1], r[4], r[5], r[11], r[16] = f"V{i}", "D", d, s, f, t
        records.append(tuple(r))
    got = {
        int(r["vehicle"][1:]): (r["duration"], r["distance"], r["fare"], r["total"])
        for r in clean_trips(spark.createDataFrame(records, schema)).collect()
    }
    want = {i: v for i, row in enumerate(rows) if (v := spec_clean(row)) is not None}
    assert got == want


# Hand-worked lines: (line, id, category), None where the line is dropped.
LINK_LINES = [
    ('"12","Cat"', "12", "Cat"),
    ('"12","A, b"', "12", "A"),
    ("12,Cat", "12", "Cat"),
    ('"1""2","C"at"', "12", "Cat"),
    (",", "", ""),
    ('"12" , "x_y"', "12 ", " x_y"),
    ('"é","é",z', "é", "é"),
    ('"12"', None, None),
    ("", None, None),
]


def test_link_lines_by_hand(spark):
    from strata.functions.text import link_category, link_doc_id

    df = spark.createDataFrame([(i, v) for i, (v, _, _) in enumerate(LINK_LINES)], "i int, value string")
    rows = df.select("i", link_doc_id("value").alias("d"), link_category("value").alias("c")).collect()
    got = {r["i"]: ((r["d"], r["c"]) if r["c"] is not None else (None, None)) for r in rows}
    assert [got[i] for i in range(len(LINK_LINES))] == [(d, c) for _, d, c in LINK_LINES]
