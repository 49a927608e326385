"""Text preparation and TF-IDF features (M1-M4, A4, A5, M7, M8, O3).

A *profile* is the one place that says how raw text becomes tokens.  Its
preparation is a stage of every fitted pipeline (``SQLTransformer``), so a saved
model takes raw text wherever it is loaded:

* ``english``: drop digits, lower-case, split on ASCII non-word characters,
  drop the English stop words, count terms, re-weight by IDF.
* ``whitespace`` (the Pashto job): reverse the text, split on whitespace runs,
  count terms, re-weight by IDF.  Reversal renames tokens one-to-one, so it is
  kept for parity and is harmless for a bag of words.

Corpus statistics are plain DataFrame aggregations: ``explode`` + ``groupBy``
with partial (map-side) aggregation, so a hot term is pre-counted on every
mapper and never lands whole on one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import (
    IDF, CountVectorizer, CountVectorizerModel, RegexTokenizer, SQLTransformer, StopWordsRemover,
)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from .prepare import with_position

#: The term that stands for a document itself; no tokenizer gives an empty term.
MARKER = ""

FEATURES = "features"
WEIGHTS = "vectorizedFeatures"


@dataclass(frozen=True)
class Profile:
    name: str
    tokens_col: str
    stop_words: tuple[str, ...] = ()
    unicode: bool = False
    vocab_size: int = C.VOCAB_SIZE

    def preparation(self, text_col: str = "text") -> SQLTransformer:
        """Null policy (P6) + the profile's text cleaning as a pipeline stage."""
        text = f"`{text_col}`"
        if self.name == "english":
            cleaned = f"SELECT * EXCEPT ({text}), regexp_replace({text}, r'{C.DIGITS}', '') AS {text}"
        else:
            cleaned = f"SELECT *, array_remove(split(reverse({text}), r'{C.PY_WHITESPACE_RUN}'), '') AS words"
        return SQLTransformer(statement=f"{cleaned} FROM __THIS__ WHERE {text} IS NOT NULL")

    def prepare(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        """The preparation alone; batch or stream."""
        return self.preparation(text_col).transform(df)

    def token_stages(self, text_col: str = "text") -> list[Transformer]:
        """Stateless stages from raw text to ``tokens_col``."""
        if self.name != "english":
            return [self.preparation(text_col)]
        tok = RegexTokenizer(inputCol=text_col, outputCol="words",
                             pattern=C.NON_WORD_UNICODE if self.unicode else C.NON_WORD)
        stages: list[Transformer] = [PipelineModel(stages=[self.preparation(text_col), tok])]
        if self.stop_words:
            stages.append(StopWordsRemover(inputCol="words", outputCol="filtered",
                                           stopWords=list(self.stop_words)))
        return stages

    def feature_stages(self, text_col: str = "text") -> list:
        """M7/M8 without the classifier: tokens -> counts -> TF-IDF."""
        return [*self.token_stages(text_col),
                CountVectorizer(inputCol=self.tokens_col, outputCol=FEATURES,
                                vocabSize=self.vocab_size),
                IDF(inputCol=FEATURES, outputCol=WEIGHTS)]


ENGLISH = Profile("english", tokens_col="filtered", stop_words=tuple(C.ENGLISH_STOP_WORDS))
WHITESPACE = Profile("whitespace", tokens_col="words")
PROFILES = {p.name: p for p in (ENGLISH, WHITESPACE)}


def get_profile(profile: str | Profile) -> Profile:
    return PROFILES[profile] if isinstance(profile, str) else profile


def with_profile(model: PipelineModel, profile: str | Profile) -> PipelineModel:
    """Note the name of a model's preparation on the model."""
    model.profile = get_profile(profile)
    return model


def tokenize(df: DataFrame, profile: str | Profile = ENGLISH, text_col: str = "text") -> DataFrame:
    """Prepared frame with the profile's token column (M1, M2); narrow, no fit."""
    return PipelineModel(stages=get_profile(profile).token_stages(text_col)).transform(df)


def prepares(model: PipelineModel) -> bool:
    """Does a pipeline begin with its preparation?  (Models saved before it was a stage do not.)"""
    first = model.stages[0]
    return isinstance(first, SQLTransformer) or (isinstance(first, PipelineModel) and prepares(first))


def doc_terms(df: DataFrame, profile: str | Profile = ENGLISH, id_col: str = "doc_id",
              text_col: str = "text", keep: Sequence[str] = (), marker: bool = False) -> DataFrame:
    """Per-document term counts ``(id, *keep, term, tf)``; ``keep`` columns must
    be functions of the document (label, split side).  With ``marker`` each
    document also counts one ``MARKER`` term, so the number of documents comes
    with the terms and needs no second scan."""
    p = get_profile(profile)
    words = F.concat(F.array(F.lit(MARKER)), F.col(p.tokens_col)) if marker else F.col(p.tokens_col)
    toks = explode_tokens(tokenize(df, p, text_col), [id_col, *keep], words, "term")
    return toks.groupBy(id_col, *keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def explode_tokens(df: DataFrame, keep: Sequence[str], arr: str | Column, name: str) -> DataFrame:
    """One row per array element.  ``explode_outer`` + a NOT NULL filter above
    it instead of ``explode``: for a plain explode Catalyst infers
    ``size(arr) > 0`` and pushes it below joins and exchanges, which evaluates
    the whole tokenizer a second time."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return df.select(*keep, F.explode_outer(a).alias(name)).filter(F.col(name).isNotNull())


def term_stats(df: DataFrame, profile: str | Profile = ENGLISH, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """A4: corpus term frequency and document frequency ``(term, tf, df)``."""
    return (doc_terms(df, profile, id_col, text_col)
            .groupBy("term")
            .agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df")))


def vocabulary_topk(stats: DataFrame, k: int = C.VOCAB_SIZE) -> DataFrame:
    """O3: the ``k`` most frequent terms in order (ties by term).  Every term has
    its place in one range-partitioned sort (``with_position``), so no task ranks
    or merges candidates, wherever the cut falls among equal frequencies."""
    placed = with_position(stats, F.desc("tf"), "term", name="_place")
    return placed.filter(F.col("_place") <= k).orderBy("_place").drop("_place")


def idf_weights(train: DataFrame, profile: str | Profile = ENGLISH, id_col: str = "doc_id",
                text_col: str = "text", vocab_size: int | None = None) -> DataFrame:
    """A5: ``(term, df, idf)`` with ``idf = ln((m + 1) / (df + 1))``, m = training
    documents; all terms, or the ``vocab_size`` most frequent."""
    return idf_from_terms(doc_terms(train, profile, id_col, text_col, marker=True), vocab_size=vocab_size)


def idf_from_terms(terms: DataFrame, fit: Column | None = None, vocab_size: int | None = None) -> DataFrame:
    """IDF from per-document terms with markers, counting only rows where ``fit``
    holds.  ``vocab_size`` keeps the most frequent terms, as ``CountVectorizer``
    does; without it no term is dropped.

    The counts read ``tf`` on purpose, and the marker is told apart by an
    aggregate: column pruning, or a filter pushed below the aggregation, would
    make this branch's plan differ from the weights branch of ``tfidf_terms``,
    and Spark would tokenize the corpus again instead of reusing the shuffle."""
    in_fit = F.col("tf") > 0 if fit is None else fit & (F.col("tf") > 0)
    stats = terms.groupBy("term").agg(
        F.count_if(in_fit).alias("df"),
        F.sum(F.when(in_fit, F.col("tf"))).alias("tf"),
        F.max(F.col("term") == MARKER).alias("_marker"))
    m = stats.filter("_marker").agg(F.coalesce(F.sum("tf"), F.lit(0))).scalar()
    stats = stats.filter(~F.col("_marker") & (F.col("df") > 0)).drop("_marker")
    if vocab_size is not None:
        stats = vocabulary_topk(stats, vocab_size)
    return stats.select("term", "df", idf_column(m, F.col("df")).alias("idf"))


def idf_column(m: Column, df_col: Column) -> Column:
    return F.log((m.cast("double") + 1.0) / (df_col.cast("double") + 1.0))


def tfidf_terms(docs: DataFrame, profile: str | Profile = ENGLISH, id_col: str = "doc_id",
                text_col: str = "text", fit: Column | None = None,
                keep: Sequence[str] = (), vocab_size: int | None = None) -> DataFrame:
    """M4 in long form: ``(id, *keep, term, tf, weight)`` for every document,
    with the IDF fitted on the rows where ``fit`` holds (all rows if None).
    Terms not seen in the fit are dropped, as the fitted vectorizer ignores
    them, and so are those beyond ``vocab_size`` if one is given.

    The text is scanned and tokenized once: the number of documents and the
    IDF are conditional counts over the same per-document terms, so all
    branches share one shuffle (Spark reuses the exchange).
    """
    p = get_profile(profile)
    fit_keep = ["_fit"] if fit is not None else []
    base = docs.withColumn("_fit", fit) if fit is not None else docs
    terms = doc_terms(base, p, id_col, text_col, [*keep, *fit_keep], marker=True)
    idf = idf_from_terms(terms, F.col("_fit") if fit is not None else None, vocab_size)
    return (terms.join(idf.select("term", "idf"), "term")
            .select(id_col, *keep, "term", "tf", (F.col("tf") * F.col("idf")).alias("weight")))


def vectorizer(tokens: DataFrame, profile: str | Profile) -> CountVectorizerModel:
    """The fitted vectorizer of a frame with the profile's token column.  Its
    vocabulary is ``vocabulary_topk``'s: at most ``vocab_size`` terms reach the
    driver, as in MLlib's own fit, but chosen and ordered before."""
    p = get_profile(profile)
    stats = explode_tokens(tokens, [], p.tokens_col, "term").groupBy("term").agg(F.count(F.lit(1)).alias("tf"))
    top = with_position(stats, F.desc("tf"), "term", name="place").filter(F.col("place") <= p.vocab_size)
    words = top.select("term", "place").toPandas().sort_values("place")["term"].tolist()
    if not words:
        raise ValueError("no term to train on")
    return _with_vocabulary(words, p.tokens_col)


def _with_vocabulary(words: list[str], tokens_col: str) -> CountVectorizerModel:
    """``CountVectorizerModel.from_vocabulary``, the words sent to the JVM in one
    call (no tokenizer leaves a line break in a word); there it takes one call per
    word, 10 s for 100,000 words."""
    sc = SparkContext.getOrCreate()
    array = sc._jvm.java.util.regex.Pattern.compile("\n").split("\n".join(words))
    model = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", array)
    return model.setInputCol(tokens_col).setOutputCol(FEATURES)


def feature_pipeline(profile: str | Profile = ENGLISH, text_col: str = "text") -> Pipeline:
    return Pipeline(stages=get_profile(profile).feature_stages(text_col))
