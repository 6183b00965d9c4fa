"""DuckDB SQL equivalents of the catalog queries (the correctness oracle).

Written independently of the Spark plans, and brute force where that is simpler
(kNN scores every query against every document).  Tables are the driver's views.
DuckDB's ``||`` (not ``concat``) propagates NULL as Spark's ``concat`` does.
"""

from __future__ import annotations

from strata.plans import catalog as C

K = C.CORPUS_K
CK = C.CLASSIFIER_K
R = 9  # decimals
RR = 6  # decimals of trip rates (values in the thousands)


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def _tokens(source: str, key: str, extra: str = "") -> str:
    return (
        f"select {key}{extra}, unnest(regexp_extract_all(lower(regexp_replace(text, "
        f"'[^a-zA-Z]', ' ', 'g')), '[a-z]+')) word from {source}"
    )


def _num(field: str) -> str:
    v = f"try_cast({field} as double)"
    return f"(case when isnan({v}) then null else {v} end)"


TRIPS = """
trips AS (
  select 'V' || cast(l_suppkey as varchar) c0,
         case when l_partkey % 50 = 0 then null else 'D' || cast(l_partkey as varchar) end c1,
         cast(l_quantity * 30 as varchar) c4,
         case when l_orderkey % 97 = 0 then 'bad' when l_orderkey % 89 = 0 then null
              else cast(l_discount * 10 as varchar) end c5,
         case when l_orderkey % 83 = 0 then 'nan' else cast(l_extendedprice as varchar) end c11,
         case when l_orderkey % 79 = 0 then null
              else cast(l_extendedprice * (1 + l_tax) as varchar) end c16
  from lineitem)"""

CLEAN = f"""
typed AS (
  select c0 vehicle, c1 driver, {_num('c4')} duration, {_num('c5')} distance,
         {_num('c11')} fare, {_num('c16')} total
  from trips),
clean AS (
  select * from typed
  where duration > 60 and distance > 0.10 and fare > 0.10 and total > 0.10)"""

PAIRS = """pairs AS (select distinct vehicle, driver from clean)"""
PER_VEHICLE = """per_vehicle AS (select vehicle, count(*) drivers from pairs group by vehicle)"""
RATES = f"""rates AS (select driver, avg(total / duration * 60) rate from clean group by driver)"""

LINKS = """
links AS (
  select cast(doc_id as varchar) doc_id, 'lang_' || lang category from documents
  union all select cast(doc_id as varchar), source from documents
  union all select cast(doc_id as varchar), 'quality_' || cast(quality as varchar) from labels
  union all select cast(doc_id as varchar), 'toxic_' || cast(toxic as varchar) from labels)"""
CPD = """cpd AS (select doc_id, count(*) count from links group by doc_id)"""
DPC = """dpc AS (select category, count(*) count from links group by category)"""

DOC_LINES = """
doc_lines AS (
  select '<doc id="' || cast(page_id as varchar) || '" url="' || url || '" title="t">'
         || html || '</doc>' value
  from pages)"""

# Text lines as a line reader sees them: a page with line breaks is several.
FILE_LINES = """
file_lines AS (select unnest(string_split(coalesce(value, ''), chr(10))) value from doc_lines)"""
PARSED_LINES = """select substring(value, strpos(value, 'id="') + 4,
                         greatest(strpos(value, '" url=') - strpos(value, 'id="') - 4, 0)) doc_id,
               substring(value, strpos(value, '">') + 2,
                         greatest(length(value) - strpos(value, '">') - 1 - 6, 0)) text
        from {source}
        where strpos(value, 'id="') > 0 and strpos(value, '" url=') > 0 and strpos(value, '">') > 0"""
REJECTED = """
judged AS (
  select 'trips' input,
         case when duration is null then 'duration is no number' when distance is null then 'distance is no number'
              when fare is null then 'fare is no number' when total is null then 'total is no number'
              when duration <= 60 then 'duration too small' when distance <= 0.10 then 'distance too small'
              when fare <= 0.10 then 'fare too small' when total <= 0.10 then 'total too small' else 'kept' end reason
  from typed
  union all
  select 'doc_lines', case when strpos(coalesce(value, ''), 'id="') = 0 then 'no id marker'
                           when strpos(value, '" url=') = 0 then 'no url marker'
                           when strpos(value, '">') = 0 then 'no body marker' else 'kept' end from doc_lines
  union all
  select 'links', case when category is null then 'no category' else 'kept' end from links)"""

CORPUS = f"""
corpus AS (select cast(doc_id as varchar) doc_id, text from documents),
tokens AS ({_tokens('corpus', 'doc_id')}),
wc AS (select word, count(*) count from tokens group by word),
vocab AS (
  select word, count, row_number() over (order by count desc, word) - 1 pos
  from wc qualify pos < {K}),
pc AS (select doc_id, pos, count(*) n from tokens join vocab using (word) group by doc_id, pos),
tf AS (select doc_id, pos, n / sum(n) over (partition by doc_id) tf from pc),
dfreq AS (select pos, count(*) df from tf group by pos),
idf AS (select pos, ln((select count(*) from corpus) / df) idf from dfreq),
tfidf AS (select doc_id, pos, tf * idf value from tf join idf using (pos))"""

BENCH_QUERIES = "queries AS (select cast(item_id as varchar) query_id, text from benchmark)"
REF_QUERIES = (
    "queries AS (select * from (values "
    + ", ".join("('{}', '{}')".format(q, t.replace("'", "''")) for q, t in C.REFERENCE_TEXTS)
    + ") v(query_id, text))"
)

QUERIES = f"""
qtokens AS ({_tokens('queries', 'query_id')}),
qpc AS (select query_id, pos, count(*) n from qtokens join vocab using (word) group by query_id, pos),
qvec AS (
  select query_id, pos, (n / sum(n) over (partition by query_id)) * idf value
  from qpc join idf using (pos)),
dnorm AS (select doc_id, sqrt(sum(value * value)) dnorm from tfidf group by doc_id),
qnorm AS (select query_id, sqrt(sum(value * value)) qnorm from qvec group by query_id),
dots AS (
  select q.query_id, t.doc_id, sum(t.value * q.value) dot
  from tfidf t join qvec q using (pos) group by q.query_id, t.doc_id),
cos AS (
  select query_id, doc_id,
         case when dnorm * qnorm = 0 then 0.0 else dot / (dnorm * qnorm) end score
  from dots join dnorm using (doc_id) join qnorm using (query_id)),
live_q AS (select distinct query_id from qvec),
docs_v AS (select distinct doc_id from tfidf)"""

NEIGHBORS = f"""
all_cos AS (
  select query_id, doc_id, coalesce(round(c.score, {R}), 0.0) score
  from live_q cross join docs_v left join cos c using (query_id, doc_id)),
nb AS (
  select query_id, row_number() over (partition by query_id order by score desc, doc_id) rank,
         doc_id, score
  from all_cos qualify rank <= {C.KNN_K})"""

CLASSIFIER = f"""
labelled AS (
  select cast(d.doc_id as varchar) doc_id, d.text, l.quality label, d.doc_id % 5 = 0 is_test
  from documents d join labels l using (doc_id)),
train_docs AS (select * from labelled where not is_test),
test_docs AS (select * from labelled where is_test),
ctok AS ({_tokens('train_docs', 'doc_id', ', label')}),
cwc AS (select word, count(*) count from ctok group by word),
cvocab AS (
  select word, count, row_number() over (order by count desc, word) - 1 pos
  from cwc qualify pos < {CK}),
train_pc AS (
  select doc_id, label, pos, count(*) n from ctok join cvocab using (word)
  group by doc_id, label, pos),
train_ex AS (
  select doc_id, label, pos, n / sum(n) over (partition by doc_id) value from train_pc
  union all select distinct doc_id, label, {CK}, 1.0::double from train_pc),
train_lab AS (select distinct doc_id, label from train_ex),
w0 AS (select range pos, 0.0::double weight from range(0, {CK + 1}))"""


def _step(i: int, lr: float = 0.60, reg: float = 0.1) -> str:
    return f"""
theta{i} AS (
  select e.doc_id, sum(e.value * w.weight) theta from train_ex e join w{i} w using (pos)
  group by e.doc_id),
res{i} AS (
  select t.doc_id, 1.0 / (1.0 + exp(-t.theta)) - l.label r,
         greatest(t.theta, 0.0) + ln(1 + exp(-abs(t.theta))) - l.label * t.theta loss
  from theta{i} t join train_lab l using (doc_id)),
grad{i} AS (
  select e.pos, sum(e.value * r.r) g from train_ex e join res{i} r using (doc_id) group by e.pos),
cost{i} AS (
  select {i} iteration,
         (select sum(loss) from res{i}) / (select count(*) from res{i})
         + {reg} * (select sum(weight * weight) from w{i}) cost),
w{i + 1} AS (
  select w.pos,
         w.weight - {lr} * (coalesce(g.g, 0.0) / (select count(*) from res{i}) + 2 * {reg} * w.weight) weight
  from w{i} w left join grad{i} g using (pos))"""


LABELLED = """
  select cast(d.doc_id as varchar) doc_id, d.text, l.quality label, d.doc_id % 5 = 0 is_test
  from documents d join labels l using (doc_id)),"""
LABELLED_BY_ID = f"""
  select cast(conv_id as varchar) doc_id, text,
         cast(contains(cast(conv_id as varchar), '{C.ID_NEEDLE}') as integer) label, conv_id % 5 = 0 is_test
  from conversations),"""
assert LABELLED in CLASSIFIER
CLASSIFIER_BY_ID = CLASSIFIER.replace(LABELLED, LABELLED_BY_ID)


def _drawn_step(i: int) -> str:
    """A step over the documents that iteration ``i`` draws (seed 1 + i)."""
    drawn = f"('0x' || substr(md5('{1 + i}:' || doc_id), 1, 13))::bigint / {float(1 << 52)}"
    lab = f"""
lab{i} AS (
  select * from train_lab
  where {drawn} < least(1.0, {C.MINIBATCH_SIZE}::double / (select count(*) from train_lab))),
ex{i} AS (select e.* from train_ex e join lab{i} using (doc_id)),"""
    return lab + _step(i).replace("train_ex", f"ex{i}").replace("train_lab", f"lab{i}")


MINI = ",\n".join(_drawn_step(i) for i in range(C.MINIBATCH_STEPS))
MINI_END = f"""
costs AS ({' union all '.join(f'select iteration, cost from cost{i}' for i in range(C.MINIBATCH_STEPS))}),
moved AS (select iteration, abs(cost - coalesce(lag(cost) over (order by iteration), 0.0)) d from costs),
stopped AS (
  select coalesce(min(iteration), {C.MINIBATCH_STEPS}) i from moved where d < {C.MINIBATCH_TOLERANCE})"""


VOTE_DOCS = f"""select query_id, category, votes from (
    select nb.query_id, l.category, count(*) votes
    from nb join links l using (doc_id) group by nb.query_id, l.category)
qualify row_number() over (partition by query_id order by votes desc, category) <= {C.KNN_K}"""

STEPS = ",\n".join(_step(i) for i in range(C.FULLBATCH_STEPS))
W_FINAL = f"w{C.FULLBATCH_STEPS}"

TEST = f"""
ttok AS ({_tokens('test_docs', 'doc_id', ', label')}),
test_pc AS (
  select doc_id, label, pos, count(*) n from ttok join cvocab using (word)
  group by doc_id, label, pos),
test_ex AS (
  select doc_id, label, pos, n / sum(n) over (partition by doc_id) value from test_pc
  union all select distinct doc_id, label, {CK}, 1.0::double from test_pc),
scored AS (
  select e.doc_id, any_value(e.label) label, sum(e.value * w.weight) score
  from test_ex e join {W_FINAL} w using (pos) group by e.doc_id),
predicted AS (select doc_id, label, score, cast(score >= 0.5 as integer) prediction from scored),
confusion AS (
  select cast(count_if(label = 1 and prediction = 1) as bigint) tp,
         cast(count_if(label = 0 and prediction = 0) as bigint) tn,
         cast(count_if(label < prediction) as bigint) fp,
         cast(count_if(label > prediction) as bigint) fn
  from predicted)"""


def _sql() -> dict[str, str]:
    trips = _with(TRIPS, CLEAN)
    pairs = _with(TRIPS, CLEAN, PAIRS, PER_VEHICLE)
    rates = _with(TRIPS, CLEAN, RATES)
    corpus = _with(CORPUS)
    knn = _with(CORPUS, BENCH_QUERIES, QUERIES)
    nb = _with(CORPUS, BENCH_QUERIES, QUERIES, NEIGHBORS)
    clf = _with(CLASSIFIER)
    by_id = _with(CLASSIFIER_BY_ID)
    fit = _with(CLASSIFIER, STEPS)
    mini = _with(CLASSIFIER, MINI, MINI_END)
    test = _with(CLASSIFIER, STEPS, TEST)
    cut = lambda n: f"limit {n}"
    return {
        "clean_trips": trips + "select vehicle, driver, duration, distance, fare, total from clean",
        "distinct_pairs": pairs + "select vehicle, driver from pairs",
        "drivers_per_vehicle": pairs + "select vehicle, drivers from per_vehicle",
        "top_vehicles": pairs
        + f"select vehicle, drivers from per_vehicle order by drivers desc, vehicle asc nulls first {cut(C.TOP_N)}",
        "mean_rate_per_driver": rates + f"select driver, round(rate, {RR}) rate from rates",
        "top_drivers": rates
        + f"select driver, round(rate, {RR}) rate from rates "
        f"order by round(rate, {RR}) desc, driver asc nulls first {cut(C.TOP_N)}",
        "doc_lines_parsed": _with(DOC_LINES)
        + PARSED_LINES.format(source="doc_lines"),
        "corpus_size": _with(DOC_LINES) + "select count(*) n from doc_lines",
        "category_links": _with(LINKS) + "select doc_id, category from links",
        "categories_per_doc": _with(LINKS, CPD) + "select doc_id, count from cpd",
        "docs_per_category": _with(LINKS, DPC) + "select category, count from dpc",
        "describe_counts": _with(LINKS, CPD)
        + f"""select count(count) n, round(avg(count), {R}) mean, round(stddev_samp(count), {R}) stddev,
               min(count) min, max(count) max from cpd""",
        "median_count": _with(LINKS, CPD)
        + "select cast(quantile_disc(count, 0.5) as bigint) median from cpd",
        "top_categories": _with(LINKS, DPC)
        + f"select category, count from dpc order by count desc, category {cut(C.TOP_N)}",
        "word_counts": corpus + "select word, count from wc",
        "top_words": corpus + f"select word, count from wc order by count desc, word {cut(C.TOP_N)}",
        "vocabulary": corpus + "select word, count, pos from vocab",
        "vocabulary_tail": corpus
        + f"select word, count, pos from vocab order by pos desc {cut(C.TAIL_N)}",
        "vocab_lookup": clf
        + "select w.word, coalesce(v.pos, -1) pos from (values "
        + ", ".join(f"('{w}')" for w in C.LOOKUP_WORDS)
        + ") w(word) left join cvocab v using (word)",
        "tokens_to_positions": corpus + "select doc_id, pos, n from pc",
        "term_frequency": corpus + f"select doc_id, pos, round(tf, {R}) tf from tf",
        "binary_presence": corpus + "select doc_id, pos, 1 present from tf",
        "document_frequency": corpus + "select pos, df from dfreq",
        "inverse_document_frequency": corpus + f"select pos, round(idf, {R}) idf from idf",
        "tf_idf": corpus + f"select doc_id, pos, round(value, {R}) value from tfidf",
        "tf_preview": corpus
        + f"""select doc_id, pos, round(tf, {R}) tf from tf
        where doc_id in (select distinct doc_id from tf order by doc_id limit {C.TF_PREVIEW_DOCS})""",
        "tfidf_preview": corpus
        + f"""select doc_id, pos, round(value, {R}) value from tfidf
        where doc_id in (select distinct doc_id from tfidf order by doc_id limit {C.TFIDF_PREVIEW_DOCS})""",
        "query_vectors": knn + f"select query_id, pos, round(value, {R}) value from qvec",
        "scores_cosine": knn
        + f"""select query_id, doc_id, round(score, {R}) score from cos
        qualify row_number() over (partition by query_id order by round(score, {R}) desc, doc_id) <= {C.KNN_K}""",
        "scores_dot": knn
        + f"""select query_id, doc_id, round(dot, {R}) score from dots
        qualify row_number() over (partition by query_id order by round(dot, {R}) desc, doc_id) <= {C.KNN_K}""",
        "knn_neighbors_dot": knn
        + f""", all_dot AS (
          select query_id, doc_id, coalesce(round(d.dot, {R}), 0.0) score
          from live_q cross join docs_v left join dots d using (query_id, doc_id))
        select query_id, row_number() over (partition by query_id order by score desc, doc_id) rank, doc_id, score
        from all_dot qualify rank <= {C.KNN_K}""",
        "knn_neighbors": nb + "select query_id, rank, doc_id, score from nb",
        "knn_vote_documents": _with(CORPUS, BENCH_QUERIES, QUERIES, NEIGHBORS, LINKS) + VOTE_DOCS,
        "knn_reference_texts": _with(CORPUS, REF_QUERIES, QUERIES, NEIGHBORS, LINKS) + VOTE_DOCS,
        "knn_vote_pairs": _with(CORPUS, BENCH_QUERIES, QUERIES, LINKS)
        + f""",
        docs_vl AS (select doc_id from docs_v where doc_id in (select doc_id from links)),
        all_dot AS (
          select query_id, doc_id, coalesce(round(d.dot, {R}), 0.0) score
          from live_q cross join docs_vl left join dots d using (query_id, doc_id)),
        top_pairs AS (
          select a.query_id, a.doc_id, l.category, a.score from all_dot a join links l using (doc_id)
          qualify row_number() over (partition by a.query_id order by a.score desc, a.doc_id, l.category)
                  <= {C.KNN_K}),
        pv AS (select query_id, category, count(*) votes from top_pairs group by query_id, category)
        select query_id, category, votes from pv
        qualify row_number() over (partition by query_id order by votes desc, category) <= {C.KNN_K}""",
        "label_by_substring": "select cast(doc_id as varchar) doc_id, "
        f"cast(contains(cast(doc_id as varchar), '{C.SUBSTRING_NEEDLE}') as integer) label from documents",
        "logreg_examples": clf + f"select doc_id, label, pos, round(value, {R}) value from train_ex",
        "logreg_train_size": clf + "select count(*) n from train_lab",
        "logreg_step": clf
        + f"""select pos, round(sum(value * (0.5 - label)) / (select count(*) from train_lab), {R}) gradient
        from train_ex group by pos""",
        "logreg_fit_fullbatch": fit + f"select pos, round(weight, {R}) weight from {W_FINAL}",
        "logreg_history": fit
        + " union all ".join(
            f"select iteration, round(cost, {R}) cost from cost{i}" for i in range(C.FULLBATCH_STEPS)
        ),
        "logreg_minibatch_weights": mini
        + f"select pos, round(weight, {R}) weight from ("
        + " union all ".join(f"select {i} i, pos, weight from w{i}" for i in range(1, C.MINIBATCH_STEPS + 1))
        + f") where i = least((select i from stopped) + 1, {C.MINIBATCH_STEPS})",
        "logreg_minibatch_history": mini
        + f"select iteration, round(cost, {R}) cost from costs where iteration < (select i from stopped)",
        "logreg_examples_by_id": by_id + f"select doc_id, label, pos, round(value, {R}) value from train_ex",
        "logreg_train_size_by_id": by_id + "select count(*) n from train_lab",
        "confusion_matrix_by_id": _with(CLASSIFIER_BY_ID, STEPS, TEST) + "select tp, tn, fp, fn from confusion",
        "logreg_score": test + f"select doc_id, label, round(score, {R}) score, prediction from predicted",
        "confusion_matrix": test + "select tp, tn, fp, fn from confusion",
        "classification_metrics": test
        + f""", m AS (
          select *, case when tp + fp = 0 then 0.0 else tp / (tp + fp) end "precision",
                    case when tp + fn = 0 then 0.0 else tp / (tp + fn) end recall,
                    case when tp + tn + fp + fn = 0 then 0.0 else (tp + tn) / (tp + tn + fp + fn) end accuracy
          from confusion)
        select tp, tn, fp, fn, round("precision", {R}) "precision", round(recall, {R}) recall,
               round(case when "precision" + recall = 0 then 0.0
                          else 2 * "precision" * recall / ("precision" + recall) end, {R}) f1,
               round(accuracy, {R}) accuracy
        from m""",
        "top_weighted_words": fit
        + f"""select w.pos, v.word, round(w.weight, {R}) weight
        from {W_FINAL} w join cvocab v using (pos) where w.pos <> {CK}
        order by w.weight desc, w.pos {cut(C.TOP_WORDS_N)}""",
        "logreg_score_loaded": test + f"select doc_id, label, round(score, {R}) score, prediction from predicted",
        "trips_from_csv": trips + "select vehicle, driver, duration, distance, fare, total from clean",
        "corpus_size_from_text": _with(DOC_LINES, FILE_LINES) + "select count(*) n from file_lines",
        "doc_lines_from_text": _with(DOC_LINES, FILE_LINES) + PARSED_LINES.format(source="file_lines"),
        "links_from_text": _with(LINKS) + "select doc_id, category from links where category is not null",
        "result_single_file": pairs
        + f"select vehicle, drivers, 1 files from per_vehicle order by drivers desc, vehicle asc nulls first {cut(C.TOP_N)}",
        "result_many_files": _with(LINKS, DPC) + "select category, count from dpc",
        "rejected_rows": _with(TRIPS, CLEAN, DOC_LINES, LINKS, REJECTED)
        + "select input, reason, count(*) rows from judged group by input, reason",
        "drivers_per_vehicle_bitmaps": pairs + "select vehicle, drivers from per_vehicle",
        "median_exact": _with(LINKS, CPD) + "select cast(quantile_disc(count, 0.5) as bigint) median from cpd",
        "vocabulary_bounded": corpus + "select word, count, pos from vocab",
    }


ORACLE_SQL: dict[str, str] = _sql()
