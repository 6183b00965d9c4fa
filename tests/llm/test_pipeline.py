import corpus_pipeline
import pytest

from test_lines import by_force as lines_by_force
from test_omh import classes_by_force
from test_pii import base_by_force, terms_by_force

from strata.llm import bpe, toxicity
from strata.llm.common import scratch, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_all_but_the_last_stage_return_the_columns_of_documents(stages):
    for df in stages[1:-1]:
        assert df.schema.simpleString() == stages[0].schema.simpleString()
        assert all(r.n_chars == len(r.text) for r in df.collect())
    assert {"doc_id", "sequence_id", "offset"} <= set(stages[-1].columns)


def test_toxic_documents_go_and_others_stay_as_they_are(spark, stages):
    scorer = toxicity.fit(stages[0], table(spark, SF, "labels"))
    scores = {r.doc_id: r.score for r in toxicity.score_documents(stages[0], scorer).collect()}
    before, after = rows(stages[0]), rows(stages[1])
    assert after == {i: r for i, r in before.items() if scores[i] < toxicity.CUTOFF}


def test_repeated_lines_go(stages):
    before, after = rows(stages[1]), rows(stages[2])
    want = lines_by_force([(i, r.text) for i, r in before.items()])
    assert {(i, before[i].text): r.text for i, r in after.items()} == want


def test_one_document_of_each_class_stays(stages):
    before, after = rows(stages[2]), rows(stages[3])
    classes = classes_by_force([(i, r.text) for i, r in before.items()])
    assert after == {i: r for i, r in before.items() if classes[i] == i}


def test_personal_data_go(stages):
    before, after = rows(stages[3]), rows(stages[4])
    docs = [(i, r.text) for i, r in before.items()]
    terms = terms_by_force(docs)
    assert set(after) == set(before)
    for i, text in docs:
        if not base_by_force(text) and (i, text) not in terms:
            assert after[i].text == text
        else:
            assert after[i].text != text and not {v for *_, v in base_by_force(text)} & {v for *_, v in base_by_force(after[i].text)}


def test_every_token_is_packed_once(stages):
    tokenizer = bpe.load(corpus_pipeline.public_tokenizers.path(corpus_pipeline.TOKENIZER))
    tokens = {}
    for p in stages[-1].collect():
        tokens[p.doc_id] = tokens.get(p.doc_id, 0) + p.length
    assert tokens == {i: len(tokenizer.ids(r.text)) + 1 for i, r in rows(stages[4]).items()}


def test_run_applies_all_stages(spark, stages):
    assert sorted(corpus_pipeline.run(spark, SF).collect(), key=str) == sorted(stages[-1].collect(), key=str)
    assert corpus_pipeline.ORACLE_SQL is None


def test_hard_rows_pass_every_stage(spark):
    hard = [(1, None, "en", None, 0), (2, "", None, "s", 0), (3, "a@b.cd\nx\ny\nz", "en", "s", 12), (3, "a@b.cd\nx\ny\nz", "en", "s", 12), (None, "q\nx\ny\nz", "en", "s", 7), (4, "w " * 50_000, "en", "s", 100_000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, class_id int, kept_text int, spans string"
    for data in ([(*r, 1, 2, "x") for r in hard], []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = scratch(stage(spark, docs, SF), name)
        assert docs.count() >= len(data)


def test_repeated_rows_of_one_id_come_once(spark):
    text = "one two three four five six seven"
    rows = [(1, text), (1, text), (2, text), (1, "another text of the same id, as it happens"), (None, text), (None, text)]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == sorted((i or 0, t) for i, t in (rows[0], *rows[3:]))


def test_near_duplicates_take_columns_of_any_name(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, "x", "y"), (1, text, "x", "y"), (2, text, None, "z"), (3, "another text altogether", "x", None), (None, text, "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _digest string, digest string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3]
