"""DuckDB SQL twins of the named queries (same column names and values).

The regular expressions are the RE2 spellings of the Java patterns in
``constants``; the Unicode classes there are written out so both engines read
them alike.  RE2's ``.`` already stops only at ``\\n``, like Python's.
"""

from __future__ import annotations

from .. import constants as C
from .queries import DEMO_KEYWORDS, DEMO_ROUTES, PHRASE_ROUTES

# The retweet pattern is written in the common subset of Java and RE2 syntax.
RT_RE2 = C.RETWEET_MARKER
URL_RE2 = r"https?.*"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _clean(expr: str) -> str:
    return (f"regexp_replace(regexp_replace({expr}, {_q(RT_RE2)}, '', 'g'), "
            f"{_q(URL_RE2)}, '', 'g')")


def _ws_tokens(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, {_q(C.PY_WHITESPACE_RUN)}), lambda x: x <> '')"


def _shape(expr: str) -> str:
    return (f"{expr} AS text, CAST(len({_ws_tokens(expr)}) AS BIGINT) AS words, "
            f"CAST(length({expr}) AS BIGINT) AS length")


def _word_tokens(expr: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({expr}), '\\W'), lambda x: x <> '')"


def _marker(id_col: str, text_col: str) -> str:
    return f"'RT @user' || CAST({id_col} AS VARCHAR) || ': ' || {text_col}"


_DIGITLESS = "regexp_replace(text, '\\d+', '', 'g')"

_STOP = "[" + ", ".join(_q(w) for w in C.ENGLISH_STOP_WORDS) + "]"

_BUCKET = "CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100"

def _labelled_cte(where: str = "") -> str:
    cond = f" WHERE {where}" if where else ""
    return f"""
labelled AS (
  SELECT d.doc_id, d.text, CAST(l.quality AS INTEGER) AS label,
         CASE WHEN l.quality = 1 THEN 'Positive' ELSE 'Negative' END AS sentiment,
         {_BUCKET.replace('doc_id', 'd.doc_id')} AS bucket
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id{cond}
)"""


LABELLED = _labelled_cte()

# English profile: digits removed, tokens on ASCII non-word chars, stop words out.
ENGLISH_WORDS = _word_tokens(_DIGITLESS)
ENGLISH_TERMS = f"list_filter(words, lambda x: NOT list_contains({_STOP}, x))"
# Whitespace (Pashto) profile: reversed text split on whitespace runs.
WHITESPACE_WORDS = _ws_tokens("reverse(text)")


def _tokens_cte(words: str = ENGLISH_WORDS, terms: str = ENGLISH_TERMS, where: str = "",
                vocab_size: int | None = None) -> str:
    """labelled -> prepared (words) -> filtered (terms) -> tf -> m -> idf; the
    fitted models' vocabulary has a size, the long forms' has none."""
    limit = f" ORDER BY total DESC, term LIMIT {vocab_size}" if vocab_size else ""
    return _labelled_cte(where) + f""",
prepared AS (
  SELECT doc_id, label, bucket, {words} AS words
  FROM labelled WHERE text IS NOT NULL
),
filtered AS (
  SELECT doc_id, label, bucket, {terms} AS terms FROM prepared
),
tf AS (
  SELECT doc_id, label, bucket, term, count(*) AS tf
  FROM (SELECT doc_id, label, bucket, unnest(terms) AS term FROM filtered)
  GROUP BY doc_id, label, bucket, term
),
m AS (SELECT count(*) AS m FROM prepared WHERE bucket < 80),
vocab AS (
  SELECT term, count(*) AS df, sum(tf) AS total FROM tf WHERE bucket < 80
  GROUP BY term{limit}
),
idf AS (
  SELECT term, df, ln((m.m + 1.0) / (df + 1.0)) AS idf FROM vocab, m
)"""


TOKENS = _tokens_cte()

_NB_PARAMS = """,
w AS (
  SELECT tf.label, tf.term, sum(tf.tf * idf.idf) AS mass
  FROM tf JOIN idf ON tf.term = idf.term WHERE tf.bucket < 80
  GROUP BY tf.label, tf.term
),
tot AS (SELECT label, sum(mass) AS total FROM w GROUP BY label),
v AS (SELECT count(*) AS v FROM idf),
n AS (SELECT count(*) AS n FROM prepared WHERE bucket < 80),
pri AS (
  SELECT label, count(*) AS n_c, ln(count(*) + 1.0) - ln(n.n + 2.0) AS log_pi
  FROM prepared, n WHERE bucket < 80 GROUP BY label, n.n
),
theta AS (
  SELECT w.label, w.term, w.mass, ln(w.mass + 1.0) - ln(tot.total + v.v) AS log_theta
  FROM w JOIN tot ON w.label = tot.label, v
)"""

NB_MODEL = TOKENS + _NB_PARAMS
NB_FITTED = _tokens_cte(vocab_size=C.VOCAB_SIZE) + _NB_PARAMS

ALL_TERMS = f"""
  SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM (
    SELECT doc_id, unnest(list_filter({ENGLISH_WORDS}, lambda x: NOT list_contains({_STOP}, x))) AS term
    FROM documents WHERE text IS NOT NULL)
  GROUP BY term"""


def _nb_scores(scored_docs: str, doc_terms: str, model: str = NB_FITTED) -> str:
    """Predictions of the closed-form NB for ``scored_docs(doc_id)`` whose term
    counts are in ``doc_terms(doc_id, term, tf)``."""
    return model + f""",
sd AS ({scored_docs}),
dt AS ({doc_terms}),
cls AS (SELECT pri.label, pri.log_pi, tot.total FROM pri JOIN tot ON pri.label = tot.label),
contrib AS (
  SELECT dt.doc_id, cls.label,
         sum(dt.tf * idf.idf * (ln(coalesce(w.mass, 0) + 1.0) - ln(cls.total + v.v))) AS s
  FROM dt JOIN idf ON dt.term = idf.term
  JOIN cls ON true
  LEFT JOIN w ON w.label = cls.label AND w.term = dt.term, v
  GROUP BY dt.doc_id, cls.label
),
score AS (
  SELECT sd.doc_id, cls.label, cls.log_pi + coalesce(contrib.s, 0) AS s
  FROM sd JOIN cls ON true
  LEFT JOIN contrib ON contrib.doc_id = sd.doc_id AND contrib.label = cls.label
),
pred AS (
  SELECT doc_id, CAST(arg_max(label, s) AS DOUBLE) AS prediction FROM score GROUP BY doc_id
)"""


_TEST_DOCS = "SELECT doc_id FROM prepared WHERE bucket >= 80"
_TEST_TERMS = "SELECT doc_id, term, tf FROM tf WHERE bucket >= 80"

WHITESPACE_TEST_PRED = "WITH " + _nb_scores(
    _TEST_DOCS, _TEST_TERMS,
    _tokens_cte(WHITESPACE_WORDS, "words", vocab_size=C.VOCAB_SIZE) + _NB_PARAMS)

NB_TEST_PRED = "WITH " + _nb_scores(_TEST_DOCS, _TEST_TERMS)

_ALL_DOC_TERMS = f"""
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(list_filter({ENGLISH_WORDS},
                                      lambda x: NOT list_contains({_STOP}, x))) AS term
    FROM documents WHERE text IS NOT NULL)
  GROUP BY doc_id, term"""

NB_ALL_PRED = "WITH " + _nb_scores(
    "SELECT doc_id FROM documents WHERE text IS NOT NULL", _ALL_DOC_TERMS)


def _routes_values() -> str:
    rows = [f"({_q(t)}, {_q(k)})" for t, kws in DEMO_ROUTES for k in kws]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS r(topic, keyword)"


ROUTED = f"""
tok AS (SELECT DISTINCT doc_id, unnest({_word_tokens("text")}) AS token FROM documents),
routes AS ({_routes_values()}),
routed AS (
  SELECT DISTINCT tok.doc_id, routes.topic FROM tok JOIN routes ON tok.token = lower(routes.keyword)
)"""

def _phrase_hits(routes) -> str:
    """``hits(doc_id, topic)``: a keyword's words are all among the text's."""
    rows = ", ".join(f"({_q(t)}, {_q(k)})" for t, kws in routes for k in kws)
    return f"""
words AS (SELECT doc_id, {_word_tokens("text")} AS tokens FROM documents),
wanted AS (SELECT topic, {_word_tokens("keyword")} AS phrase FROM (VALUES {rows}) AS r(topic, keyword)),
hits AS (SELECT DISTINCT doc_id, topic FROM words JOIN wanted ON len(phrase) > 0 AND list_has_all(tokens, phrase))"""


ENVELOPE = f"""WITH {ROUTED}
SELECT hex(encode({_clean("d.text")})) AS value_hex, routed.topic, true AS null_key
FROM routed JOIN documents d ON routed.doc_id = d.doc_id"""

TWEET_SHAPE = f"SELECT doc_id, {_shape(_clean('text'))} FROM documents"


def _tokens_sql(split: str) -> str:
    return (f"SELECT doc_id, CAST(len({split}) AS BIGINT) AS n_tokens, "
            f"array_to_string({split}, '|') AS tokens FROM documents")


_PART_TEXT = _clean("text")

BEST_SPLIT = TOKENS + """,
rows AS (SELECT doc_id, label FROM prepared WHERE bucket < 80 AND label IN (0, 1)),
total AS (SELECT count(*)::DOUBLE AS n, sum(label)::DOUBLE AS pos FROM rows),
bins AS (
  SELECT tf.term, tf.tf, max(tf.tf * idf.idf) AS weight, count(*)::DOUBLE AS n, sum(tf.label)::DOUBLE AS pos
  FROM tf JOIN idf USING (term) WHERE tf.bucket < 80 AND tf.label IN (0, 1) GROUP BY tf.term, tf.tf
),
cuts AS (
  SELECT term, sum(tf * n) OVER (PARTITION BY term) AS uses, (coalesce(lag(weight) OVER s, 0) + weight) / 2 AS threshold,
         sum(n) OVER (PARTITION BY term ORDER BY tf DESC) AS rn, sum(pos) OVER (PARTITION BY term ORDER BY tf DESC) AS rp
  FROM bins WINDOW s AS (PARTITION BY term ORDER BY tf)
),
sides AS (
  SELECT cuts.*, n, pos, n - rn AS ln, pos - rp AS lp FROM cuts, total WHERE rn < n
),
gains AS (
  SELECT term, uses, threshold,
         1 - pow(pos / n, 2) - pow(1 - pos / n, 2)
         - ln / n * (1 - pow(lp / ln, 2) - pow(1 - lp / ln, 2))
         - rn / n * (1 - pow(rp / rn, 2) - pow(1 - rp / rn, 2)) AS gain
  FROM sides
)"""

ORACLE: dict[str, str] = {
    "tweet_shape": TWEET_SHAPE,
    "conversation_shape": f"SELECT conv_id, turn, role, {_shape(_clean('text'))} FROM conversations",
    "strip_retweet": f"SELECT doc_id, regexp_replace({_marker('doc_id', 'text')}, "
                     f"{_q(RT_RE2)}, '', 'g') AS text FROM documents",
    "strip_urls": f"SELECT page_id, regexp_replace(html, {_q(URL_RE2)}, '', 'g') AS text FROM pages",
    "clean_tweet": f"SELECT page_id, {_shape(_clean(_marker('page_id', 'html')))} FROM pages",
    "remove_digits": "SELECT doc_id, regexp_replace(text, '\\d+', '', 'g') AS text FROM documents",
    "reverse_text": "SELECT doc_id, reverse(text) AS text FROM documents",
    "space_tokens": _tokens_sql("string_split(text, ' ')"),
    "whitespace_tokens": _tokens_sql(_ws_tokens("text")),
    "ingest_clock": "SELECT event_id, CAST(hour(ts) AS VARCHAR) || ':' || CAST(minute(ts) AS VARCHAR) "
                    "|| '.' || CAST(second(ts) AS VARCHAR) AS clock FROM events",
    "keyword_filter": "SELECT doc_id FROM documents WHERE list_has_any("
                      f"{_word_tokens('text')}, [{', '.join(_q(k) for k in DEMO_KEYWORDS)}])",
    "keyword_route": f"WITH {ROUTED} SELECT doc_id, topic FROM routed",
    "keyword_route_wide": f"""
        WITH rows AS (
          SELECT row_number() OVER () AS r, doc_id, text, lang FROM (
            SELECT CASE WHEN doc_id % 2 = 0 THEN doc_id END AS doc_id, text, lang FROM documents
            UNION ALL
            SELECT CASE WHEN doc_id % 2 = 0 THEN doc_id END AS doc_id, text, lang FROM documents)
        ), tok AS (SELECT DISTINCT r, doc_id, lang, unnest({_word_tokens("text")}) AS token FROM rows),
        kw AS (SELECT DISTINCT token, 'topic_' || substr(token, 1, 1) AS topic FROM tok WHERE lang = 'de')
        SELECT doc_id, topic FROM (SELECT DISTINCT r, doc_id, topic FROM tok JOIN kw USING (token))""",
    "keyword_phrases": f"WITH {_phrase_hits(PHRASE_ROUTES)} SELECT doc_id, topic FROM hits",
    "keyword_phrase_filter": f"WITH {_phrase_hits(PHRASE_ROUTES[:2])} SELECT DISTINCT doc_id FROM hits",
    "kafka_envelope": ENVELOPE,
    "kafka_payload": "SELECT text, lang AS topic FROM documents",
    "rename_project": "SELECT doc_id, text FROM documents",
    "null_policy": "SELECT doc_id, lang FROM documents "
                   "WHERE (CASE WHEN lang = 'es' THEN NULL ELSE text END) IS NOT NULL",
    "literal_labels": "SELECT doc_id, 'Positive' AS sentiment, 1 AS label FROM documents",
    "literal_rows": f"""
        SELECT k.text, count(t.token) AS n
        FROM (SELECT unnest([{', '.join(_q(k) for k in DEMO_KEYWORDS)}, NULL]) AS text) k
        LEFT JOIN (SELECT unnest({_word_tokens("text")}) AS token FROM documents) t ON t.token = k.text
        GROUP BY k.text""",
    "schema_columns": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS filled FROM documents"
        for c, t in (("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
                     ("n_chars", "bigint"))),
    "class_counts_nulls": """
        SELECT label, CASE WHEN label = 1 THEN 'Positive' WHEN label = 0 THEN 'Negative' END AS sentiment,
               count(*) AS n
        FROM (SELECT CASE WHEN l.doc_id % 7 = 0 THEN NULL WHEN l.doc_id % 11 = 0 THEN 5
                     ELSE CAST(quality AS INTEGER) END AS label
              FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
        GROUP BY label""",
    "hash_split_nulls": f"""
        SELECT lang, CASE WHEN doc_id % 3 <> 0 AND {_BUCKET} < 80 THEN 'train' ELSE 'test' END AS side,
               count(*) AS n
        FROM documents GROUP BY 1, 2""",
    "index_labels": f"""
        WITH {LABELLED}, c AS (SELECT sentiment, count(*) AS n FROM labelled WHERE label IN (0, 1) GROUP BY sentiment),
        r AS (SELECT sentiment, CAST(row_number() OVER (ORDER BY n DESC, sentiment) - 1 AS DOUBLE) AS idx FROM c)
        SELECT doc_id, sentiment, idx AS label FROM labelled JOIN r USING (sentiment)""",
    "shuffle_rows": f"SELECT doc_id, lang, row_number() OVER (ORDER BY md5('{C.RANDOM_SPLIT_SEED}:' || doc_id), doc_id) "
                    "AS position FROM documents",
    "area_under_roc": f"""
        WITH {LABELLED}, x AS (SELECT label, length(text) AS s FROM labelled WHERE label IN (0, 1)),
        r AS (SELECT label, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r FROM x),
        t AS (SELECT sum(label) AS p, count(*) - sum(label) AS q, sum(CASE WHEN label = 1 THEN r END) AS s FROM r)
        SELECT 'areaUnderROC' AS metric, round(CAST((s - p * (p + 1) / 2.0) / (p * q) AS DOUBLE), 6) AS value FROM t""",
    "nb_area_under_roc": NB_TEST_PRED + """, x AS (
            SELECT p.label, round(max(CASE WHEN s.label = 1 THEN s.s END) - max(CASE WHEN s.label = 0 THEN s.s END), 6) AS s
            FROM score s JOIN prepared p USING (doc_id) WHERE p.label IN (0, 1) GROUP BY p.doc_id, p.label),
        r AS (SELECT label, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r FROM x),
        t AS (SELECT sum(label) AS p, count(*) - sum(label) AS q, sum(CASE WHEN label = 1 THEN r END) AS s FROM r)
        SELECT 'areaUnderROC' AS metric, round(CAST((s - p * (p + 1) / 2.0) / (p * q) AS DOUBLE), 6) AS value FROM t""",
    "labelled_union": "SELECT d.doc_id, d.text, 'Positive' AS sentiment, 1 AS label "
                      "FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 1 "
                      "UNION ALL "
                      "SELECT d.doc_id, d.text, 'Negative' AS sentiment, 0 AS label "
                      "FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 0",
    "class_counts": f"WITH {LABELLED} SELECT label, sentiment, count(*) AS n FROM labelled "
                    "GROUP BY label, sentiment",
    "label_sort": f"WITH {LABELLED} SELECT doc_id, label, row_number() OVER (ORDER BY label, doc_id) "
                  "AS position FROM labelled",
    "hash_split": f"WITH {LABELLED} SELECT doc_id, label, "
                  "CASE WHEN bucket < 80 THEN 'train' ELSE 'test' END AS side FROM labelled",
    "preview": f"WITH {LABELLED} SELECT doc_id, sentiment, label FROM labelled "
               "ORDER BY doc_id LIMIT 5",
    "regex_tokens": "SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, "
                    "array_to_string(t, '|') AS tokens FROM ("
                    f"SELECT doc_id, {_word_tokens(_DIGITLESS)} AS t "
                    "FROM documents WHERE text IS NOT NULL)",
    "stopword_filtered": "SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, "
                         "array_to_string(t, '|') AS tokens FROM ("
                         f"SELECT doc_id, list_filter({_word_tokens(_DIGITLESS)}, "
                         f"lambda x: NOT list_contains({_STOP}, x)) AS t "
                         "FROM documents WHERE text IS NOT NULL)",
    "term_frequency": ALL_TERMS,
    "vocabulary_topk": f"SELECT term, tf FROM ({ALL_TERMS}) ORDER BY tf DESC, term LIMIT {C.VOCAB_SIZE}",
    "vocabulary_top_1000": f"SELECT term, tf FROM ({ALL_TERMS}) ORDER BY tf DESC, term LIMIT 1000",
    "idf_weights": f"WITH {TOKENS} SELECT term, df, round(idf, 6) AS idf FROM idf",
    "tfidf_terms": f"WITH {TOKENS} SELECT tf.doc_id, tf.term, tf.tf, "
                   "round(tf.tf * idf.idf, 6) AS weight FROM tf JOIN idf ON tf.term = idf.term",
    "nb_priors": f"WITH {NB_MODEL} SELECT label, n_c AS n, round(log_pi, 6) AS log_pi FROM pri",
    "nb_parameters": f"WITH {NB_MODEL} SELECT label, term, round(mass, 6) AS mass, "
                     "round(log_theta, 6) AS log_theta FROM theta",
    "nb_predictions": NB_TEST_PRED + " SELECT p.doc_id, p.label, pred.prediction "
                      "FROM prepared p JOIN pred ON p.doc_id = pred.doc_id",
    "nb_accuracy": NB_TEST_PRED + " SELECT 'naive_bayes' AS model, 'accuracy' AS metric, "
                   "round(avg(CASE WHEN pred.prediction = p.label THEN 1.0 ELSE 0.0 END), 6) AS value "
                   "FROM prepared p JOIN pred ON p.doc_id = pred.doc_id",
    "whitespace_nb": WHITESPACE_TEST_PRED + " SELECT p.doc_id, p.label, pred.prediction "
                           "FROM prepared p JOIN pred ON p.doc_id = pred.doc_id",
    "model_roundtrip": NB_TEST_PRED + " SELECT p.doc_id, p.label, pred.prediction "
                       "FROM prepared p JOIN pred ON p.doc_id = pred.doc_id",
    "shared_fit": NB_TEST_PRED + " SELECT p.doc_id, p.label, pred.prediction "
                  "FROM prepared p JOIN pred ON p.doc_id = pred.doc_id",
    "nb_score_texts": "WITH " + _nb_scores(
        "SELECT item_id AS doc_id FROM benchmark WHERE text IS NOT NULL",
        _ALL_DOC_TERMS.replace("SELECT doc_id, unnest", "SELECT item_id AS doc_id, unnest").replace("FROM documents", "FROM benchmark"))
        + " SELECT doc_id AS item_id, prediction FROM pred",
    "lr_stationarity": f"WITH {TOKENS} SELECT term, true AS stationary FROM idf UNION ALL SELECT '(intercept)', true",
    "tree_root_split": f"WITH {BEST_SPLIT}, best AS (SELECT term, threshold FROM gains "
                       "ORDER BY round(gain, 10) DESC, uses DESC, term, threshold LIMIT 1) "
                       "SELECT source, term, round(threshold, 6) AS threshold "
                       "FROM best, (VALUES ('fitted'), ('searched')) AS s(source)",
    "self_contained_model": NB_TEST_PRED + " SELECT p.doc_id, p.label, pred.prediction "
                            "FROM prepared p JOIN pred ON p.doc_id = pred.doc_id",
    "self_contained_whitespace": WHITESPACE_TEST_PRED + " SELECT p.doc_id, p.label, pred.prediction "
                                 "FROM prepared p JOIN pred ON p.doc_id = pred.doc_id",
    "json_source": "SELECT doc_id, text FROM documents",
    "csv_source": "SELECT doc_id, text FROM documents",
    "json_corrupt": """
        SELECT CASE WHEN good THEN doc_id END AS doc_id, CASE WHEN good THEN text END AS text, line FROM (
          SELECT *, line IS NULL AS good FROM (SELECT *, CASE
            WHEN doc_id % 7 = 0 THEN '{"doc_id": ' || doc_id || ', "text": "cut'
            WHEN doc_id % 11 = 0 THEN '{"doc_id": "x' || doc_id || '", "text": "typed"}'
            WHEN doc_id % 13 = 0 THEN 'no json ' || doc_id END AS line FROM documents))""",
    "csv_corrupt": """
        SELECT CASE WHEN line IS NULL THEN doc_id END AS doc_id, CASE WHEN line IS NULL THEN lang END AS text, line FROM (
          SELECT *, CASE WHEN doc_id % 7 = 0 THEN 'x' || doc_id || ',' || lang
                         WHEN doc_id % 11 = 0 THEN doc_id || ',' || lang || ',more' END AS line FROM documents)""",
    "table_append": TWEET_SHAPE,
    "stream_tweet_shape": TWEET_SHAPE,
    "stream_batch_counts": "SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS n FROM documents",
    "stream_rows_read": f"""
        SELECT CAST({_BUCKET} % 3 AS BIGINT) AS batch_id, count(*) AS rows_read,
               count(*) FILTER (lang = 'de' AND {_BUCKET} % 3 < 2) AS rows_written FROM documents GROUP BY 1""",
    "stream_compaction": f"SELECT CAST({_BUCKET} % 6 AS BIGINT) AS batch_id, doc_id, {_shape(_PART_TEXT)} FROM documents",
    "stream_trigger": TWEET_SHAPE,
    "stream_two_runs": f"SELECT {_shape(_clean('text'))} FROM documents "
                       f"UNION ALL SELECT {_shape(_clean('text'))} FROM conversations",
    "stream_replay": TWEET_SHAPE,
    "empty_batch": f"""
        SELECT CAST(CASE WHEN {_BUCKET} < 50 THEN 0 ELSE 2 END AS BIGINT) AS batch_id, count(*) AS n
        FROM documents GROUP BY 1""",
    "stream_route": ENVELOPE,
    "stream_kafka_score": NB_ALL_PRED + f" SELECT {_DIGITLESS} AS text, pred.prediction "
                          "FROM documents JOIN pred USING (doc_id) WHERE text IS NOT NULL",
    "stream_score": NB_ALL_PRED + " SELECT doc_id, prediction FROM pred",
}
