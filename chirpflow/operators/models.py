"""Sentiment models on TF-IDF.

Training fits the feature stages once on the training part (M9), persists the
featurized rows, then fits each classifier on them.  Every returned model is a
full ``PipelineModel`` (preparation + features + classifier): saved, it can be
loaded by MLlib alone and applied to raw texts, batch or stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import trees
from ..session import ensure_checkpoint_dir
from ..sinks.tables import save_model
from .features import (
    ENGLISH, FEATURES, WEIGHTS, Profile, doc_terms, get_profile, idf_from_terms, prepares, vectorizer, with_profile,
)
from .prepare import NEGATIVE, POSITIVE, class_frame, hash_split, known_labels, union_classes, with_position


#: Session setting with the number of partitions that classifiers are fitted on
#: (unset: as many as the training rows have).  For training sets of a few
#: partitions' size; on large ones each task has enough to do.
FIT_SETTING = "spark.chirpflow.fit.partitions"


#: Fitted by ``trees.fit``: MLlib's own fit makes every vector as wide as the vocabulary.
TREES = ("rf", "dt", "gbt")


def classifier(name: str, label_col: str = "label"):
    """M5 (lr), M6 (nb) and the imported-but-unused tree models."""
    common = {"featuresCol": WEIGHTS, "labelCol": label_col}
    if name == "lr":
        return LogisticRegression(**common)
    if name == "nb":
        return NaiveBayes(modelType="multinomial", **common)
    if name == "rf":
        return RandomForestClassifier(**common)
    if name == "dt":
        return DecisionTreeClassifier(**common)
    if name == "gbt":
        return GBTClassifier(**common)
    raise ValueError(f"unknown classifier {name!r}")


def fit_models(train: DataFrame, profile: str | Profile = ENGLISH,
               names: Sequence[str] = ("lr", "nb"), text_col: str = "text",
               label_col: str = "label", reliable: bool = True,
               fit_partitions: int | None = None) -> dict[str, PipelineModel]:
    """M9: fit the feature stages once, then one classifier per name.

    The training text is scanned and tokenized once: the token arrays are
    persisted (MEMORY_AND_DISK, recomputed from lineage if an executor is
    lost) for the vectorizer and IDF passes, then the TF-IDF vectors are stored
    for the classifiers and the tokens released.  With ``reliable`` (default)
    they are written to the shared ``spark.checkpoint.dir``
    (``DataFrame.checkpoint``), which cuts the lineage: an executor lost during
    the many LR iterations costs a re-read of its vectors, not a re-scan and
    re-tokenization of the raw text; without it they are persisted.  An iterative
    classifier caches its own form of them.
    Rows whose label is not 0 or 1 are left out.  ``fit_partitions``, or else the
    session's ``FIT_SETTING`` (unset: off), merges the stored vectors into that
    many partitions: L-BFGS sends a gradient as wide as the vocabulary for each
    task in each iteration.
    """
    p = get_profile(profile)
    token_stages = p.token_stages(text_col)
    tokens = PipelineModel(stages=token_stages).transform(known_labels(train, label_col))
    tokens = tokens.select(p.tokens_col, label_col).persist(StorageLevel.MEMORY_AND_DISK)
    featurized = None
    try:
        counts = vectorizer(tokens, p)
        counted = counts.transform(tokens)
        idf = IDF(inputCol=FEATURES, outputCol=WEIGHTS).fit(counted)
        featurized = idf.transform(counted).select(WEIGHTS, label_col)
        if reliable:
            ensure_checkpoint_dir(featurized.sparkSession)
            featurized = featurized.checkpoint(eager=True)
            tokens.unpersist()
        else:
            featurized = featurized.persist(StorageLevel.MEMORY_AND_DISK)
        parts = fit_partitions or featurized.sparkSession.conf.get(FIT_SETTING, None)
        fit_input = featurized.coalesce(int(parts)) if parts else featurized
        models = {}
        for name in names:
            clf = classifier(name, label_col)
            clf = trees.fit(clf, fit_input) if name in TREES else clf.fit(fit_input)
            models[name] = with_profile(PipelineModel(stages=[*token_stages, counts, idf, clf]), p)
        return models
    finally:
        tokens.unpersist()
        if featurized is not None and not reliable:
            featurized.unpersist()


def _raw(df: DataFrame, model: PipelineModel, profile: str | Profile | None, text_col: str) -> DataFrame:
    """What a model's stages expect: raw texts, or prepared ones for a model that
    was saved before its preparation was a stage."""
    if prepares(model):
        return df
    return get_profile(profile or getattr(model, "profile", ENGLISH)).prepare(df, text_col)


def score_texts(df: DataFrame, model: PipelineModel, profile: str | Profile | None = None,
                text_col: str = "text") -> DataFrame:
    """The model applied to raw texts.  The preparation is one of its
    stages; ``profile`` counts only for a model without it.  Any number of rows,
    batch or stream."""
    return model.transform(_raw(df, model, profile, text_col))


def score_all(df: DataFrame, models: dict[str, PipelineModel],
              profile: str | Profile | None = None, text_col: str = "text") -> DataFrame:
    """Several models in one pass: ``prediction_<name>`` per model.

    Models from one ``fit_models`` call share their fitted feature stages, also
    after saving and loading (stages keep their uid), so the text is prepared
    and vectorized once and each classifier adds its own output columns (no
    per-model scan, no join of the results).  Models that do not share feature
    stages are rejected; score them with ``score_texts``.
    """
    out = _raw(df, next(iter(models.values())), profile, text_col)
    done: list = []
    for name, model in models.items():
        *feats, clf = model.stages
        if [s.uid for s in feats] != [s.uid for s in done]:
            if done:
                raise ValueError("score_all needs models with shared feature stages")
            out = PipelineModel(stages=feats).transform(out)
            done = feats
        clf = clf.copy()
        clf.setPredictionCol(f"prediction_{name}")
        for setter, col in (("setRawPredictionCol", "rawPrediction"),
                            ("setProbabilityCol", "probability")):
            if hasattr(clf, setter):
                getattr(clf, setter)(f"{col}_{name}")
        out = clf.transform(out)
    return out


def accuracies(scored: DataFrame, names: Sequence[str], label_col: str = "label") -> DataFrame:
    """M12 from one ``score_all`` frame: one aggregate pass, rows
    ``(model, metric, value)``."""
    label = F.col(label_col).cast("double")
    agg = scored.agg(*[F.avg((F.col(f"prediction_{n}") == label).cast("double")).alias(n)
                       for n in names])
    rows = [F.struct(F.lit(n).alias("model"), F.lit("accuracy").alias("metric"),
                     F.col(n).alias("value")) for n in names]
    return agg.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def accuracy(pred: DataFrame, model_name: str | None = None, label_col: str = "label") -> DataFrame:
    """A3 as a distributed aggregate: ``(model, metric, value)``."""
    value = F.avg((F.col("prediction") == F.col(label_col).cast("double")).cast("double"))
    out = pred.agg(value.alias("value"))
    return out.select(F.lit(model_name).alias("model"), F.lit("accuracy").alias("metric"), "value")


def area_under_roc(scored: DataFrame, score: str | Column = "rawPrediction", label_col: str = "label") -> DataFrame:
    """X4, exact: ``(metric, value)`` from the ranks of the positive rows, without bins.

    Every row gets its place in the order of scores (``with_position``: a
    range-partitioned sort and a prefix sum over partition counts).  Rows of equal
    score share the mean of their places, so first, last and the number of
    positives per score are enough; they are summed exactly as decimals.  A vector
    of raw predictions counts by its second entry.  Rows without a score or a
    label 0 or 1 are left out; the value is NULL unless both labels occur."""
    column = F.col(score) if isinstance(score, str) else score
    if scored.select(column).schema[0].dataType.typeName() == "vectorudt":
        column = vector_to_array(column)[1]
    rows = known_labels(scored, label_col).select(column.cast("double").alias("_score"),
                                                  F.col(label_col).cast("int").alias("_label")).filter("_score IS NOT NULL")
    tied = (with_position(rows, "_score", name="_place").groupBy("_score")
            .agg(F.min("_place").alias("first"), F.max("_place").alias("last"), F.sum("_label").alias("positives"),
                 F.count(F.lit(1)).alias("n")))
    whole = "decimal(38,0)"
    twice = F.sum(F.col("positives").cast("decimal(18,0)") * (F.col("first") + F.col("last")).cast("decimal(19,0)"))
    sums = tied.agg(twice.cast(whole).alias("twice"), F.sum("positives").alias("p"),
                    (F.sum("n") - F.sum("positives")).alias("q"))
    above = F.col("twice") - (F.col("p").cast("decimal(18,0)") * (F.col("p") + 1).cast("decimal(19,0)"))
    pairs = F.col("p").cast("double") * F.col("q").cast("double") * 2
    return sums.select(F.lit("areaUnderROC").alias("metric"),
                       F.when(pairs > 0, above.cast("double") / pairs).alias("value"))


def evaluate(pred: DataFrame, metric: str = "accuracy", label_col: str = "label") -> float:
    """A3 (accuracy, f1, ...) through MLlib's evaluator; areaUnderROC (X4) exactly,
    areaUnderPR from MLlib's curve over all distinct scores."""
    if metric == "areaUnderROC":
        return area_under_roc(pred, label_col=label_col).first()["value"]
    if metric == "areaUnderPR":
        ev = BinaryClassificationEvaluator(labelCol=label_col, metricName=metric, numBins=0)
    else:
        ev = MulticlassClassificationEvaluator(labelCol=label_col, predictionCol="prediction",
                                               metricName=metric)
    return ev.evaluate(pred)


def compare_models(preds: dict[str, DataFrame], label_col: str = "label") -> DataFrame:
    """Both accuracies side by side as rows ``(model, metric, value)``."""
    frames = [accuracy(p, name, label_col) for name, p in preds.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def nb_priors(train: DataFrame, label_col: str = "label") -> DataFrame:
    """A6, priors: ``log_pi = ln(n_c + 1) - ln(n + #classes)`` per label, from
    one scan: the sums over classes run over the counts, one row per class."""
    counts = (train.filter(F.col(label_col).isNotNull()).groupBy(label_col)
              .agg(F.count(F.lit(1)).alias("n")))
    every = Window.partitionBy(F.lit(1))
    n, k = F.sum("n").over(every), F.count(F.lit(1)).over(every)
    return counts.select(label_col, "n", (F.log(F.col("n") + 1.0) - F.log((n + k).cast("double"))).alias("log_pi"))


def nb_parameters(train: DataFrame, profile: str | Profile = ENGLISH, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "label",
                  vocab_size: int | None = None) -> DataFrame:
    """A6, likelihoods of multinomial NB on TF-IDF with smoothing 1, in long form
    ``(label, term, mass, log_theta)`` for every observed (label, term):
    ``log_theta = ln(mass + 1) - ln(total_c + V)``; unobserved pairs have
    ``mass = 0``.  The text is scanned and tokenized once: the label rides along
    with each document's terms, the number of documents is a marker term, and
    the totals per class (a map with one entry per class) and the vocabulary's
    size are scalar subqueries over the same shuffle."""
    p = get_profile(profile)
    labelled = train.filter(F.col(label_col).isNotNull())
    terms = doc_terms(labelled, p, id_col, text_col, keep=[label_col], marker=True)
    idf = idf_from_terms(terms, vocab_size=vocab_size)
    vocab = idf.agg(F.count(F.lit(1))).scalar()
    weights = terms.join(idf.select("term", "idf"), "term").select(
        label_col, "term", (F.col("tf") * F.col("idf")).alias("weight"))
    mass = weights.groupBy(label_col, "term").agg(F.sum("weight").alias("mass"))
    totals = (mass.groupBy(label_col).agg(F.sum("mass").alias("total"))
              .agg(F.map_from_entries(F.collect_list(F.struct(label_col, "total")))).scalar())
    return mass.select(label_col, "term", "mass",
                       (F.log(F.col("mass") + 1.0) - F.log(F.element_at(totals, F.col(label_col)) + vocab.cast("double")))
                       .alias("log_theta"))


def train_sentiment(positive: DataFrame, negative: DataFrame, profile: str | Profile = ENGLISH,
                    key: str = "text", names: Sequence[str] = ("lr", "nb"),
                    model_dir: str | None = None, text_col: str = "text"):
    """Job 3: label the two class frames (1 Positive, 0 Negative), union them,
    split 80/20 on ``key`` (the text: copies stay on one side), fit the feature stages once and every classifier,
    evaluate on the held-out part and optionally save each model under
    ``model_dir/<name>``.  Returns ``(models, comparison frame)``."""
    data = union_classes(class_frame(positive, POSITIVE, 1), class_frame(negative, NEGATIVE, 0))
    train, test = hash_split(data, key)
    models = fit_models(train, profile, names, text_col)
    if model_dir:
        for name, model in models.items():
            save_model(model, f"{model_dir.rstrip('/')}/{name}")
    return models, accuracies(score_all(test, models, profile, text_col), list(models))
