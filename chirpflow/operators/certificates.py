"""Certificates for fitted models (M5, X3): DataFrame aggregations over the
long-form TF-IDF that say whether a model is what its definition asks for,
without repeating the fit.

A logistic regression without regularization is right where the gradient of the
mean log loss vanishes; a decision tree's root is right if no other split of any
term has a larger Gini gain.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .features import ENGLISH, Profile, tfidf_terms
from .prepare import known_labels

#: The name under which the intercept is reported; no tokenizer gives it.
INTERCEPT = "(intercept)"


def vocabulary_of(model: PipelineModel) -> list[str]:
    return next(s for s in model.stages if isinstance(s, CountVectorizerModel)).vocabulary


def lr_coefficients(model: PipelineModel) -> DataFrame:
    """``(term, coefficient)`` of a fitted pipeline, at most one row per entry of its vocabulary."""
    from pyspark.sql import SparkSession
    lr = model.stages[-1]
    rows = pa.table({"term": pa.array(vocabulary_of(model), pa.string()),
                     "coefficient": pa.array(lr.coefficients.toArray())})
    return SparkSession.getActiveSession().createDataFrame(rows)


def lr_gradient(train: DataFrame, model: PipelineModel, profile: str | Profile = ENGLISH, id_col: str = "doc_id",
                text_col: str = "text", label_col: str = "label") -> DataFrame:
    """``(term, coefficient, gradient, scale)`` of the mean log loss on ``train``,
    one row per coefficient and one for the intercept.

    A document's margin is the sum of its weights times the coefficients; the
    gradient of a term is the mean of (probability - label) times its weight, and
    ``scale`` the mean of its absolute weights, the largest gradient that residuals
    of 1 could give.  Both sums are partial before they are exchanged."""
    rows = known_labels(train, label_col).filter(F.col(text_col).isNotNull())
    weights = tfidf_terms(rows, profile, id_col, text_col, keep=[label_col])
    coefficients = lr_coefficients(model)
    margins = weights.join(coefficients, "term").groupBy(id_col).agg(
        F.sum(F.col("weight") * F.col("coefficient")).alias("_margin"))
    margin = F.coalesce("_margin", F.lit(0.0)) + F.lit(float(model.stages[-1].intercept))
    residuals = rows.select(id_col, label_col).join(margins, id_col, "left").select(
        id_col, (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)) - F.col(label_col)).alias("_residual"))
    n = residuals.agg(F.count(F.lit(1))).scalar()
    slopes = weights.join(residuals, id_col).groupBy("term").agg(
        F.sum(F.col("weight") * F.col("_residual")).alias("_sum"), F.sum(F.abs("weight")).alias("_size"))
    own = coefficients.join(slopes, "term", "left").select(
        "term", "coefficient", (F.coalesce("_sum", F.lit(0.0)) / n).alias("gradient"),
        (F.coalesce("_size", F.lit(0.0)) / n).alias("scale"))
    whole = residuals.agg((F.sum("_residual") / F.count(F.lit(1))).alias("gradient")).select(
        F.lit(INTERCEPT).alias("term"), F.lit(float(model.stages[-1].intercept)).alias("coefficient"), "gradient",
        F.lit(1.0).alias("scale"))
    return own.unionByName(whole)


def lr_stationarity(train: DataFrame, model: PipelineModel, tolerance: float = 0.01, **how) -> DataFrame:
    """``(term, stationary)``: whether each coefficient's gradient is within
    ``tolerance`` of what residuals of 1 would give."""
    g = lr_gradient(train, model, **how)
    return g.select("term", (F.abs("gradient") <= F.lit(tolerance) * F.col("scale") + F.lit(1e-12)).alias("stationary"))


def _gini(positive, n):
    share = positive / n
    return F.lit(1.0) - share * share - (F.lit(1.0) - share) * (F.lit(1.0) - share)


def split_gains(train: DataFrame, profile: str | Profile = ENGLISH, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "label") -> DataFrame:
    """``(term, uses, threshold, gain)`` for every split of the training rows on one
    term's weight: thresholds lie half way between the weights that occur, with 0
    for documents without the term.

    The histogram has one row per term and count; its prefix sums run per term, so
    a window holds as many rows as the term has different counts.  Documents
    without the term are the totals minus the rest, so nothing is made dense."""
    rows = known_labels(train, label_col).filter(F.col(text_col).isNotNull())
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(label_col).alias("pos"))
    n, pos = (totals.select(F.col(c).cast("double")).scalar() for c in ("n", "pos"))
    bins = tfidf_terms(rows, profile, id_col, text_col, keep=[label_col]).groupBy("term", "tf").agg(
        F.max("weight").alias("weight"), F.count(F.lit(1)).cast("double").alias("n"),
        F.sum(label_col).cast("double").alias("pos"))
    term = Window.partitionBy("term")
    ordered = term.orderBy("tf")
    from_here = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    right = bins.select("term", F.sum(F.col("tf") * F.col("n")).over(term).cast("bigint").alias("uses"),
                        ((F.coalesce(F.lag("weight").over(ordered), F.lit(0.0)) + F.col("weight")) / 2).alias("threshold"),
                        F.sum("n").over(from_here).alias("rn"), F.sum("pos").over(from_here).alias("rp"))
    two_sided = right.select("*", n.alias("n"), pos.alias("pos")).filter(F.col("rn") < F.col("n"))
    ln, lp = F.col("n") - F.col("rn"), F.col("pos") - F.col("rp")
    gain = (_gini(F.col("pos"), F.col("n")) - ln / F.col("n") * _gini(lp, ln)
            - F.col("rn") / F.col("n") * _gini(F.col("rp"), F.col("rn")))
    return two_sided.select("term", "uses", "threshold", gain.alias("gain"))


def best_split(train: DataFrame, **how) -> DataFrame:
    """``(term, threshold, gain)`` of the largest gain; ties as a tree has them: the
    more frequent term first, as in the vocabulary, then the lower threshold."""
    key = F.struct((-F.round("gain", 10)).alias("order"), (-F.col("uses")).alias("uses"), "term", "threshold", "gain")
    return split_gains(train, **how).agg(F.min(key).alias("best")).select("best.term", "best.threshold", "best.gain")


def tree_root(model: PipelineModel) -> tuple[str, float] | None:
    """Term and threshold at the root of a fitted decision tree; None for a single leaf."""
    found = re.search(r"If \(feature (\d+) <= ([-+.0-9eE]+)\)", model.stages[-1].toDebugString)
    return (vocabulary_of(model)[int(found[1])], float(found[2])) if found else None
