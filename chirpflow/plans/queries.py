"""Named queries: ``(spark, sf_dir) -> DataFrame``, one per operator group.

Each query reads the driver's Parquet tables whole.  Outputs use stable column
names and only SQL-comparable types (arrays joined to strings, binaries as hex,
doubles rounded to 6 places) so ``oracle.py`` can express the same result in
DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T
from ..operators import certificates as CT
from ..operators import features as FT
from ..operators import filters as FL
from ..operators import models as M
from ..operators import prepare as P
from ..session import scratch_path
from ..sinks.compaction import read_batches
from ..sinks.kafka import kafka_frame
from ..sinks.tables import append_batch, append_to_table, save_model
from ..sources.files import read_csv_texts, read_json_texts, read_records, read_table, texts_frame
from ..sources.kafka import payload_text
from ..sources.models import load_model
from ..streaming import jobs as S

Query = Callable[[SparkSession, str], DataFrame]

# Keyword filter used by ``keyword_filter`` (one frequent word per language).
DEMO_KEYWORDS = ["nicht", "avec", "para"]

# Routes used by the routing queries: the collectors' keyword table (fixed
# values: their topics and keywords) plus one topic per corpus language, so the
# driver's invented prose has matches.
DEMO_ROUTES = [
    ("afghan_tweets", ["afghan", "afghanistan", "taliban", "TalibanOurGaurdians"]),
    ("taliban_tweets", ["taliban", "TalibanOurGaurdians"]),
    ("afghan_afghanistan_tweets", ["afghan", "afghanistan"]),
    ("afghan_refugee_tweets", ["afghanrefugees", "afghanrefugeeswelcom"]),
    ("english_tweets", ["this", "from"]),
    ("french_tweets", ["avec", "dans"]),
    ("german_tweets", ["nicht", "und"]),
    ("spanish_tweets", ["para", "por"]),
]


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their sentiment label (``labels.quality``)."""
    return P.attach_labels(_docs(spark, sf_dir).select("doc_id", "text"),
                           read_table(spark, sf_dir, "labels"))


def _train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return P.hash_split(_labelled(spark, sf_dir), "doc_id")


def _joined(arr) -> F.Column:
    return F.array_join(arr, "|")


def _r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------- text shape

def tweet_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: clean (F3) then ``(text, words, length)``."""
    return _docs(spark, sf_dir).select("doc_id", *T.shape(T.clean_tweet("text")))


def conversation_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship shaping on the second text source, conversation turns."""
    turns = read_table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", "role", *T.shape(T.clean_tweet("text")))


def _with_retweet_marker(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(id_col, F.concat(F.lit("RT @user"), F.col(id_col).cast("string"),
                                      F.lit(": "), F.col(text_col)).alias("text"))


def strip_retweet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 on documents with a retweet marker prepended."""
    df = _with_retweet_marker(_docs(spark, sf_dir), "doc_id", "text")
    return df.select("doc_id", T.strip_retweet("text").alias("text"))


def strip_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 on raw web pages (every page has URLs)."""
    return read_table(spark, sf_dir, "pages").select(
        "page_id", T.strip_urls("html").alias("text"))


def clean_tweet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 on pages with a retweet marker prepended: marker and URLs removed."""
    df = _with_retweet_marker(read_table(spark, sf_dir, "pages"), "page_id", "html")
    return df.select("page_id", *T.shape(T.clean_tweet("text")))


def remove_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4."""
    return _docs(spark, sf_dir).select("doc_id", T.remove_digits("text").alias("text"))


def reverse_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5."""
    return _docs(spark, sf_dir).select("doc_id", T.reverse_text("text").alias("text"))


def space_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """split on one space, empty tokens kept."""
    toks = T.space_tokens("text")
    return _docs(spark, sf_dir).select(
        "doc_id", F.size(toks).cast("bigint").alias("n_tokens"), _joined(toks).alias("tokens"))


def whitespace_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """split on whitespace runs, as Python ``str.split()``."""
    toks = T.whitespace_tokens("text")
    return _docs(spark, sf_dir).select(
        "doc_id", F.size(toks).cast("bigint").alias("n_tokens"), _joined(toks).alias("tokens"))


def ingest_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F11 on event timestamps."""
    return read_table(spark, sf_dir, "events").select("event_id", T.clock_label("ts").alias("clock"))


# ------------------------------------------------------------ keyword routing

def keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10."""
    return FL.keyword_filter(_docs(spark, sf_dir), DEMO_KEYWORDS).select("doc_id")


def keyword_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, topic)`` for every matching topic."""
    return FL.keyword_route(_docs(spark, sf_dir), FL.routes_frame(spark, DEMO_ROUTES))


def keyword_route_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11 with every token of the German documents as a keyword (over 10,000 on
    all but the smallest data), each document read twice, half of them without an
    id: a topic counts once per row, never per id."""
    docs = _docs(spark, sf_dir).select(
        F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")).alias("doc_id"), "text", "lang")
    words = (FT.explode_tokens(docs.filter("lang = 'de'"), [], T.regex_tokens("text"), "keyword").distinct()
             .select(F.concat(F.lit("topic_"), F.substring("keyword", 1, 1)).alias("topic"), "keyword"))
    return FL.keyword_route(docs.unionAll(docs), words)


# Keywords of several words, as a track list allows them: one more topic per pair.
PHRASE_ROUTES = [
    ("english_pair", ["the and", "of in, is", "THIS"]), ("french_pair", ["le la", "dans avec"]),
    ("german_pair", ["der und", "nicht", "!!!"]), ("both", ["the le", "un,una", "on On"]),
]


def keyword_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11 with keywords of several words: all of them in the text, in any order."""
    return FL.keyword_route(_docs(spark, sf_dir), FL.routes_frame(spark, PHRASE_ROUTES))


def keyword_phrase_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10 with the same keywords."""
    keywords = [k for _, kws in PHRASE_ROUTES[:2] for k in kws]
    return FL.keyword_filter(_docs(spark, sf_dir), keywords).select("doc_id")


def kafka_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as Kafka rows, and their payload as text again."""
    frame = kafka_frame(_docs(spark, sf_dir), topic="lang")
    return payload_text(frame, keep_topic=True)


def kafka_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 in batch form: route raw text, publish cleaned text."""
    return _envelope_rows(S.routed_frame(_docs(spark, sf_dir), FL.routes_frame(spark, DEMO_ROUTES)))


def _envelope_rows(frame: DataFrame) -> DataFrame:
    return frame.select(F.hex("value").alias("value_hex"), "topic",
                        F.col("key").isNull().alias("null_key"))


# ------------------------------------------------------ projection and labels

def rename_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + P2: CSV-style ``col0, col1`` renamed to ``doc_id, text``."""
    raw = _docs(spark, sf_dir).selectExpr("doc_id AS col0", "text AS col1", "lang")
    return P.project(P.rename(raw, {"col0": "doc_id", "col1": "text"}), "doc_id", "text")


def null_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 on documents whose Spanish texts are blanked to NULL."""
    df = _docs(spark, sf_dir).withColumn(
        "text", F.when(F.col("lang") == "es", F.lit(None)).otherwise(F.col("text")))
    return FL.drop_null_text(df).select("doc_id", "lang")


def literal_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 + F12: literal class columns on a class frame, as the training scripts add them."""
    docs = _docs(spark, sf_dir).select("doc_id")
    return P.with_literal(docs, "sentiment", P.POSITIVE).withColumn("label", T.literal(1))


def literal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal texts with an explicit schema, counted as words of the documents."""
    wanted = texts_frame(spark, [*DEMO_KEYWORDS, None])
    words = FT.explode_tokens(_docs(spark, sf_dir), [], T.regex_tokens("text"), "text")
    return wanted.join(words.groupBy("text").agg(F.count(F.lit(1)).alias("n")), "text", "left").select(
        "text", F.coalesce("n", F.lit(0)).alias("n"))


def schema_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 + K5: columns and types of documents, with each column's rows that are not NULL."""
    docs = _docs(spark, sf_dir)
    counts = docs.agg(*[F.count(c).alias(c) for c in docs.columns])
    filled = counts.select(F.explode(F.create_map(*[x for c in docs.columns for x in (F.lit(c), F.col(c))]))
                           .alias("column", "filled"))
    return P.schema_frame(docs).join(filled, "column")


def class_counts_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 where every seventh label is NULL and every eleventh unknown: neither is a class."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.when(
        F.col("doc_id") % 7 == 0, F.lit(None)).when(F.col("doc_id") % 11 == 0, F.lit(5)).otherwise(
        F.col("quality")).alias("quality"))
    return P.class_counts(P.attach_labels(_docs(spark, sf_dir).select("doc_id"), labels))


def hash_split_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O4 keyed where every third key is NULL: each row is on exactly one side."""
    rows = _docs(spark, sf_dir).select(F.when(F.col("doc_id") % 3 != 0, F.col("doc_id")).alias("doc_id"), "lang")
    train, test = P.hash_split(rows)
    return (train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
            .groupBy("lang", "side").agg(F.count(F.lit(1)).alias("n")))


def index_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels learnt from the class names, the most frequent first."""
    labelled = P.known_labels(_labelled(spark, sf_dir)).select("doc_id", "sentiment")
    return P.index_labels(labelled)[1]


def shuffle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows in a keyed random order, each with its place."""
    return P.shuffle_rows(_docs(spark, sf_dir).select("doc_id", "lang"), key="doc_id", position="position")


def area_under_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well the text's length alone ranks the labels, over all labelled rows."""
    scored = _labelled(spark, sf_dir).select("label", T.char_length("text").alias("score"))
    return M.area_under_roc(scored, "score").select("metric", _r6("value").alias("value"))


def nb_area_under_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4 on classifier scores: the NB model's log odds of the held-out rows."""
    models, test = _fitted(spark, sf_dir, ("nb",))
    raw = vector_to_array("rawPrediction")
    scored = M.score_texts(test, models["nb"]).select("label", F.round(raw[1] - raw[0], 6).alias("score"))
    return M.area_under_roc(scored, "score").select("metric", _r6("value").alias("value"))


def labelled_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One frame per class (as the two input files), then UNION ALL."""
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels")
    pos = P.class_frame(docs.join(labels.filter("quality = 1").select("doc_id"), "doc_id"),
                        P.POSITIVE, 1)
    neg = P.class_frame(docs.join(labels.filter("quality = 0").select("doc_id"), "doc_id"),
                        P.NEGATIVE, 0)
    return P.union_classes(pos, neg, by_name=False)


def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1."""
    return P.class_counts(_labelled(spark, sf_dir))


def label_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1, each row with its place in the order."""
    return P.label_sort(_labelled(spark, sf_dir).select("doc_id", "label"), position="position")


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O4 keyed: ``side`` = train/test from the md5 bucket of doc_id."""
    return P.with_split_side(_labelled(spark, sf_dir).select("doc_id", "label"))


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: first five labelled rows by doc_id."""
    return P.preview(_labelled(spark, sf_dir).select("doc_id", "sentiment", "label"), 5)


def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 + O4 faithful: sort by label, then ``randomSplit([0.8, 0.2], 5000)``
    (layout-dependent, so checked by row count only)."""
    train, test = P.random_split(_labelled(spark, sf_dir).select("doc_id", "label"),
                                 sort_first="label")
    return (train.withColumn("side", F.lit("train"))
            .unionByName(test.withColumn("side", F.lit("test"))))


# ------------------------------------------------------------------ features

def regex_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 + M1 (digits removed, lower-cased, split on ASCII non-word chars)."""
    toks = FT.tokenize(_docs(spark, sf_dir), FT.ENGLISH)
    return toks.select("doc_id", F.size("words").cast("bigint").alias("n_tokens"),
                       _joined("words").alias("tokens"))


def stopword_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 after M1."""
    toks = FT.tokenize(_docs(spark, sf_dir), FT.ENGLISH)
    return toks.select("doc_id", F.size("filtered").cast("bigint").alias("n_tokens"),
                       _joined("filtered").alias("tokens"))


def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: ``(term, tf, df)`` over all documents."""
    return FT.term_stats(_docs(spark, sf_dir))


def vocabulary_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: the vectorizer's vocabulary, most frequent first (2^18 terms max)."""
    return FT.vocabulary_topk(FT.term_stats(_docs(spark, sf_dir)), C.VOCAB_SIZE).select("term", "tf")


def vocabulary_top_1000(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3 with a limit that cuts through terms of equal frequency."""
    return FT.vocabulary_topk(FT.term_stats(_docs(spark, sf_dir)), 1000).select("term", "tf")


def idf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: IDF of every training term."""
    train, _ = _train_test(spark, sf_dir)
    idf = FT.idf_weights(train)
    return idf.select("term", "df", _r6("idf").alias("idf"))


def tfidf_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 in long form for every labelled document, IDF from the training part."""
    labelled = _labelled(spark, sf_dir)
    w = FT.tfidf_terms(labelled, fit=P.split_bucket("doc_id") < C.TRAIN_PERCENT)
    return w.select("doc_id", "term", "tf", _r6("weight").alias("weight"))


# -------------------------------------------------------------------- models

def nb_priors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 priors, closed form."""
    train, _ = _train_test(spark, sf_dir)
    pri = M.nb_priors(FT.ENGLISH.prepare(train))
    return pri.select("label", "n", _r6("log_pi").alias("log_pi"))


def nb_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 likelihoods, closed form ``(label, term, mass, log_theta)``."""
    train, _ = _train_test(spark, sf_dir)
    par = M.nb_parameters(train)
    return par.select("label", "term", _r6("mass").alias("mass"),
                      _r6("log_theta").alias("log_theta"))


def _fitted(spark: SparkSession, sf_dir: str, names=("lr", "nb"), profile=FT.ENGLISH,
            labelled: DataFrame | None = None):
    data = labelled if labelled is not None else _labelled(spark, sf_dir)
    train, test = P.hash_split(data)
    return M.fit_models(train, profile, names), test


def nb_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 + M10: MLlib NB pipeline fitted on the training part, held-out rows."""
    models, test = _fitted(spark, sf_dir, ("nb",))
    pred = M.score_texts(test, models["nb"])
    return pred.select("doc_id", "label", "prediction")


def nb_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 on the NB predictions."""
    models, test = _fitted(spark, sf_dir, ("nb",))
    return M.accuracy(M.score_texts(test, models["nb"]), "naive_bayes").select(
        "model", "metric", _r6("value").alias("value"))


def lr_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 + M10 (iterative fit: rows-only check)."""
    models, test = _fitted(spark, sf_dir, ("lr",))
    return M.score_texts(test, models["lr"]).select("doc_id", "label", "prediction")


def lr_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 on the LR predictions."""
    models, test = _fitted(spark, sf_dir, ("lr",))
    return M.accuracy(M.score_texts(test, models["lr"]), "logistic_regression")


def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9 + M12: one shared feature fit, two classifiers, accuracies side by
    side; the held-out rows are scanned and vectorized once for both."""
    models, test = _fitted(spark, sf_dir, ("lr", "nb"))
    named = {"logistic_regression": models["lr"], "naive_bayes": models["nb"]}
    return M.accuracies(M.score_all(test, named), list(named))


def whitespace_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 (reverse, whitespace split, counts, IDF, NB) on the documents of all languages."""
    models, test = _fitted(spark, sf_dir, ("nb",), FT.WHITESPACE)
    return M.score_texts(test, models["nb"]).select("doc_id", "label", "prediction")


def whitespace_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 with the other classifier of that job (iterative fit: rows-only check)."""
    models, test = _fitted(spark, sf_dir, ("lr",), FT.WHITESPACE)
    return M.score_texts(test, models["lr"]).select("doc_id", "label", "prediction")


def tree_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree classifiers on the same features (rows-only check)."""
    models, test = _fitted(spark, sf_dir, ("rf", "dt", "gbt"))
    return M.accuracies(M.score_all(test, models), list(models))


def score_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score the ``benchmark`` texts with both models in one pass."""
    models, _ = _fitted(spark, sf_dir, ("lr", "nb"))
    items = read_table(spark, sf_dir, "benchmark")
    scored = M.score_all(items, {"lr": models["lr"], "nb": models["nb"]})
    return scored.select("item_id", F.col("prediction_lr").alias("lr"),
                         F.col("prediction_nb").alias("nb"))


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 + S7: save the NB pipeline, load it, score the held-out rows."""
    models, test = _fitted(spark, sf_dir, ("nb",))
    path = save_model(models["nb"], scratch_path(spark, "models", "naive-bayes"))
    return M.score_texts(test, load_model(path)).select("doc_id", "label", "prediction")


def shared_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9 + M12: NB from a fit it shares with LR, both applied in one pass."""
    models, test = _fitted(spark, sf_dir, ("lr", "nb"))
    return M.score_all(test, models).select("doc_id", "label", F.col("prediction_nb").alias("prediction"))


def nb_score_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NB on the ``benchmark`` texts, which are in no training row."""
    models, _ = _fitted(spark, sf_dir, ("nb",))
    return M.score_texts(read_table(spark, sf_dir, "benchmark"), models["nb"]).select("item_id", "prediction")


def lr_stationarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: the gradient of the log loss vanishes at every fitted coefficient."""
    train, _ = _train_test(spark, sf_dir)
    return CT.lr_stationarity(train, M.fit_models(train, names=("lr",))["lr"])


def tree_root_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted decision tree's root, and the best split over all terms' histograms."""
    train, _ = _train_test(spark, sf_dir)
    root = CT.tree_root(M.fit_models(train, names=("dt",))["dt"])
    fitted = spark.createDataFrame([("fitted", *root)] if root else [], "source string, term string, threshold double")
    searched = CT.best_split(train).select(F.lit("searched").alias("source"), "term", "threshold")
    return fitted.unionByName(searched).select("source", "term", _r6("threshold").alias("threshold"))


def self_contained_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 + S7: the saved NB pipeline loaded by MLlib alone takes raw texts."""
    models, test = _fitted(spark, sf_dir, ("nb",))
    path = save_model(models["nb"], scratch_path(spark, "models", "naive-bayes"))
    return PipelineModel.load(path).transform(test).select("doc_id", "label", "prediction")


def self_contained_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the pipeline of the whitespace job (M8)."""
    models, test = _fitted(spark, sf_dir, ("nb",), FT.WHITESPACE)
    path = save_model(models["nb"], scratch_path(spark, "models", "whitespace"))
    return PipelineModel.load(path).transform(test).select("doc_id", "label", "prediction")


# ------------------------------------------------------------ sources, sinks

def json_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON lines, read back with a declared schema."""
    path = scratch_path(spark, "json", "documents")
    _docs(spark, sf_dir).select("doc_id", "text").write.json(path)
    return read_json_texts(spark, path, "doc_id BIGINT, text STRING", ("doc_id", "text"))


def csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as header-less CSV, read with a DDL schema.  The
    texts hold line breaks, so the files are read as a whole each (``multi_line``)."""
    path = scratch_path(spark, "csv", "documents")
    (_docs(spark, sf_dir).select("doc_id", "text").write.option("header", False)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    df = read_csv_texts(spark, path, "col0 BIGINT, col1 STRING", keep=["col0"], multi_line=True)
    return df.withColumnRenamed("col0", "doc_id")


def json_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 with malformed lines: cut off, of another type, and no JSON at all."""
    path = scratch_path(spark, "json", "corrupt")
    doc = F.col("doc_id").cast("string")
    line = (F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit('{"doc_id": '), doc, F.lit(', "text": "cut')))
            .when(F.col("doc_id") % 11 == 0, F.concat(F.lit('{"doc_id": "x'), doc, F.lit('", "text": "typed"}')))
            .when(F.col("doc_id") % 13 == 0, F.concat(F.lit("no json "), doc))
            .otherwise(F.to_json(F.struct("doc_id", "text"))))
    _docs(spark, sf_dir).select(line.alias("value")).write.text(path)
    return _good_and_rejected(*read_records(spark, path, "doc_id BIGINT, text STRING"))


def csv_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 with malformed lines: a word for a number, a field too many."""
    path = scratch_path(spark, "csv", "corrupt")
    doc = F.col("doc_id").cast("string")
    line = (F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("x"), doc, F.lit(","), F.col("lang")))
            .when(F.col("doc_id") % 11 == 0, F.concat(doc, F.lit(","), F.col("lang"), F.lit(",more")))
            .otherwise(F.concat(doc, F.lit(","), F.col("lang"))))
    _docs(spark, sf_dir).select(line.alias("value")).write.text(path)
    return _good_and_rejected(*read_records(spark, path, "doc_id BIGINT, text STRING", "csv"))


def _good_and_rejected(good: DataFrame, rejected: DataFrame) -> DataFrame:
    return good.select("doc_id", "text", F.lit(None).cast("string").alias("line")).unionByName(
        rejected.select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("text"), "line"))


def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 in batch: two appends into one catalog table, read back whole."""
    path = scratch_path(spark, "tables", "tweets")
    table = "tweets_" + path.rsplit("/", 1)[-1]
    shaped = tweet_shape(spark, sf_dir)
    first, second = P.hash_split(shaped, "doc_id", 50)
    append_to_table(first, table, path)
    append_to_table(second, table, path)
    return spark.table(table)


# ---------------------------------------------------------------- streaming

def _doc_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _docs(spark, sf_dir).schema
    return S.read_text_stream(spark, _stream_path(sf_dir, "documents"), schema)


def _stream_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parq[u]et"


def _drain(spark: SparkSession, df: DataFrame, name: str, transform=None) -> str:
    path = scratch_path(spark, "streams", name)
    S.run_to_table(df, path + "/table", path + "/checkpoint", transform=transform)
    return path + "/table"


def _shape_batch(batch: DataFrame) -> DataFrame:
    return S.shape_stream(batch, keep=["doc_id"])


def stream_tweet_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream-to-table job, drained with availableNow; the
    shaping runs per micro-batch."""
    raw = _doc_stream(spark, sf_dir).select("doc_id", "text")
    path = _drain(spark, raw, "shape", transform=_shape_batch)
    return spark.read.parquet(path).select("doc_id", "text", "words", "length")


def stream_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2/T5: rows per micro-batch (shaping inside the streaming plan, T2)."""
    path = _drain(spark, S.shape_stream(_doc_stream(spark, sf_dir), keep=["doc_id"]), "counts")
    return S.batch_counts(spark, path).select("batch_id", "n")


def _growing_source(spark: SparkSession, sf_dir: str, path: str, parts: int):
    """Yields after each of ``parts`` parts of the documents has arrived in ``path``."""
    docs = _docs(spark, sf_dir).select("doc_id", "text", "lang")
    for part in range(parts):
        docs.filter(P.split_bucket("doc_id") % parts == part).write.mode("append").parquet(path)
        yield docs.schema


def stream_rows_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2/T5: rows read and written per micro-batch where the batch step keeps one
    language only; the last batch has none of it and still counts."""
    path = scratch_path(spark, "streams", "rows-read")
    for part, schema in enumerate(_growing_source(spark, sf_dir, path + "/in", 3)):
        S.run_to_table(S.read_text_stream(spark, path + "/in", schema), path + "/table", path + "/checkpoint",
                       transform=lambda b, wanted="de" if part < 2 else "none": _shape_batch(b.filter(F.col("lang") == wanted)),
                       counts=path + "/counts")
    return S.rows_per_batch(spark, path + "/counts").select("batch_id", "rows_read", "rows_written")


def stream_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six micro-batches compacted every second batch, two of them replayed
    after their compaction; every row is there once, with its batch."""
    path = scratch_path(spark, "streams", "compaction")
    for schema in _growing_source(spark, sf_dir, path + "/in", 6):
        query = S.run_to_table(S.read_text_stream(spark, path + "/in", schema), path + "/table", path + "/checkpoint",
                               transform=_shape_batch, compact_every=2)
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    for batch_id in (1, 3):
        append_batch(docs.filter(P.split_bucket("doc_id") % 6 == batch_id), batch_id, path + "/table",
                     query_id=str(query.id), transform=_shape_batch)
    return read_batches(spark, path + "/table").select("batch_id", "doc_id", "text", "words", "length")


def stream_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5-second trigger, stopped when it has taken what there is."""
    path = scratch_path(spark, "streams", "trigger")
    query = S.run_to_table(_doc_stream(spark, sf_dir).select("doc_id", "text"), path + "/table", path + "/checkpoint",
                           trigger=S.PRODUCTION_TRIGGER, transform=_shape_batch)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.parquet(path + "/table").select("doc_id", "text", "words", "length")


def stream_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6 + K2: two inputs through two checkpoints into one table; both stay."""
    path = scratch_path(spark, "streams", "two")
    for name, col in (("documents", "text"), ("conversations", "text")):
        schema = read_table(spark, sf_dir, name).schema
        stream = S.read_text_stream(spark, _stream_path(sf_dir, name), schema).select(F.col(col).alias("text"))
        S.run_to_table(stream, path + "/table", f"{path}/checkpoint-{name}", transform=S.shape_stream)
    return spark.read.parquet(path + "/table").select("text", "words", "length")


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query runs again on its checkpoint, and its batch is written again; no row doubles."""
    path = scratch_path(spark, "streams", "replay")
    for _ in range(2):
        S.run_to_table(_doc_stream(spark, sf_dir).select("doc_id", "text"), path + "/table", path + "/checkpoint",
                       transform=_shape_batch)
    return spark.read.parquet(path + "/table").select("doc_id", "text", "words", "length")


def empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty micro-batch between two others writes nothing."""
    path = scratch_path(spark, "streams", "empty")
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    first, second = P.hash_split(docs, "doc_id", 50)
    for batch_id, batch in enumerate((first, docs.filter("false"), second)):
        append_batch(batch, batch_id, path, transform=_shape_batch)
    return spark.read.parquet(path).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))


def stream_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route + clean + Kafka frame per micro-batch of a stream of texts
    alone, drained to a table."""
    routes = FL.routes_frame(spark, DEMO_ROUTES)
    path = _drain(spark, _doc_stream(spark, sf_dir).select("text"), "route",
                  transform=lambda batch: S.routed_frame(batch, routes))
    return _envelope_rows(spark.read.parquet(path))


def stream_kafka_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 end to end after the broker: rows in Kafka's column contract, the
    payload, a reloaded model, the scored table."""
    models, _ = _fitted(spark, sf_dir, ("nb",))
    model = save_model(models["nb"], scratch_path(spark, "models", "naive-bayes"))
    path = scratch_path(spark, "streams", "kafka-score")
    kafka_frame(_docs(spark, sf_dir), topic="lang").write.parquet(path + "/topic")
    schema = spark.read.parquet(path + "/topic").schema
    texts = payload_text(S.read_text_stream(spark, path + "/topic", schema))
    S.scored_texts_to_table(texts, model, path + "/table", path + "/checkpoint", trigger=S.DRAIN_TRIGGER)
    return spark.read.parquet(path + "/table").select("text", "prediction")


def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved NB pipeline applied to the document stream."""
    models, _ = _fitted(spark, sf_dir, ("nb",))
    path = save_model(models["nb"], scratch_path(spark, "models", "naive-bayes"))
    scored = S.score_stream(_doc_stream(spark, sf_dir), path, keep=["doc_id"])
    out = _drain(spark, scored, "score")
    return spark.read.parquet(out).select("doc_id", "prediction")


QUERIES: dict[str, Query] = {
    f.__name__: f for f in [
        tweet_shape, conversation_shape, strip_retweet, strip_urls, clean_tweet, remove_digits, reverse_text,
        space_tokens, whitespace_tokens, ingest_clock,
        keyword_filter, keyword_route, keyword_route_wide, keyword_phrases, keyword_phrase_filter,
        kafka_envelope, kafka_payload,
        rename_project, null_policy, literal_labels, literal_rows, schema_columns, labelled_union,
        class_counts, class_counts_nulls, label_sort, hash_split, hash_split_nulls, preview, random_split,
        index_labels, shuffle_rows, area_under_roc, nb_area_under_roc,
        regex_tokens, stopword_filtered, term_frequency, vocabulary_topk, vocabulary_top_1000, idf_weights,
        tfidf_terms,
        nb_priors, nb_parameters, nb_predictions, nb_accuracy, lr_predictions, lr_accuracy,
        model_comparison, whitespace_nb, whitespace_lr, tree_accuracy, score_texts, model_roundtrip,
        shared_fit, nb_score_texts, lr_stationarity, tree_root_split, self_contained_model, self_contained_whitespace,
        json_source, csv_source, json_corrupt, csv_corrupt, table_append,
        stream_tweet_shape, stream_batch_counts, stream_rows_read, stream_compaction, stream_trigger, stream_two_runs, stream_replay, empty_batch, stream_route,
        stream_score, stream_kafka_score,
    ]
}
