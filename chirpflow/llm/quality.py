"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics (shares of character classes, word lengths, repetition, lines,
compressibility, ...) are computed from whole texts, inside tasks.  The trees
are grown from histograms of binned statistics on a bounded sample of labelled
rows, and flattened into one array per field, complete trees level by level,
so that a batch of documents walks through all trees as array lookups.

Edge cases: a NULL text counts as empty; an empty text gets the score its zero
statistics lead to; without labels, or with one class only, every score is the
smoothed share of label 1; conflicting labels count as separate rows; equal
rows get equal scores; an empty table gives an empty result; ``lang``,
``source``, ``doc_id`` and the labels are never inputs.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .line_rules import CONTINUATION, SPACE, SYMBOLS, repeated_words

FIT_ROWS = 20_000        # labelled documents sampled for the fit, at most twice as many
TREES, DEPTH, BINS, RATE, SMOOTH, LEAST = 120, 4, 64, 0.1, 1.0, 10.0
THRESHOLD = 0.3
#: Frequent function words of four languages.
FUNCTION_WORDS = frozenset(
    b"the of and to in a is that for on with as by this be are it was or an at from not have de la le les et des en "
    b"du un une est que pour dans der die und den von zu das mit sich des ist im el los y las por con una para".split())
PUNCTUATION, DIGITS = b".,;:!?", b"0123456789"
UPPER, VOWELS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"aeiouAEIOU"
NAMES = ("log_bytes", "log_words", "log_lines", "mean_word", "sd_word", "longest_word", "long_words", "single_letters",
         "distinct_words", "top_word", "function_words", "word_entropy", "punctuation", "digits", "upper", "symbols",
         "non_ascii", "white", "vowels", "sentence_ends", "line_words", "ended_lines", "repeated_lines",
         "repeated_windows", "deflated", "capital_words", "odd_words", "distinct_bytes")

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def statistics(data: bytes | None) -> list[float]:
    """The statistics of one whole text, in the order of ``NAMES``."""
    data = data or b""
    n, words = len(data), data.split()
    if not words:
        return [float(np.log1p(n))] + [0.0] * (len(NAMES) - 1)
    def share(chars):
        return (n - len(data.translate(None, chars))) / n
    k = len(words)
    sizes = np.fromiter(map(len, words), np.float64, k)
    counts = Counter(words)
    freq = np.fromiter(counts.values(), np.float64, len(counts)) / k
    lines = [x for x in data.split(b"\n") if x.strip()]
    ended = sum(x.rstrip(SPACE)[-1:] in b".!?" for x in lines)
    ends = n - len(data.translate(None, b".!?"))
    odd = sum(c for w, c in counts.items() if not w.isalpha() and not w.strip(b".,;:!?\"'()-").isalpha())
    function = sum(c for w, c in counts.items() if w.strip(b".,").lower() in FUNCTION_WORDS)
    capital = sum(c for w, c in counts.items() if 65 <= w[0] <= 90)
    return [float(np.log1p(n)), float(np.log1p(k)), float(np.log1p(len(lines))), float(sizes.mean()),
            float(sizes.std()), float(np.log1p(sizes.max())), float((sizes > 12).mean()), float((sizes == 1).mean()),
            len(counts) / k, float(freq.max()), function / k, float(-(freq * np.log(freq)).sum()),
            share(PUNCTUATION), share(DIGITS), share(UPPER), share(SYMBOLS), share(bytes(range(128, 256))),
            share(SPACE), share(VOWELS), ends / k, k / len(lines), ended / len(lines),
            1 - len(set(lines)) / len(lines), repeated_words(words) / k, len(zlib.compress(data, 1)) / n,
            capital / k, odd / k, float(len(set(data)))]


# ---------------------------------------------------------------- the trees

def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS,
              rate: float = RATE) -> dict:
    """Boosted trees on log loss.  Returns flat arrays: ``feature`` and
    ``limit`` ``(trees, 2**depth - 1)``, go right where the statistic is above
    the limit, and ``leaf`` ``(trees, 2**depth)``."""
    n, f = x.shape if len(x) else (0, len(NAMES))
    prior = (float(y.sum()) + 0.5) / (n + 1.0)
    start = float(np.log(prior / (1 - prior)))
    empty = {"start": start, "feature": np.zeros((0, 2 ** depth - 1), np.int64),
             "limit": np.zeros((0, 2 ** depth - 1)), "leaf": np.zeros((0, 2 ** depth)), "depth": depth}
    if n == 0 or y.min() == y.max():
        return empty
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(f)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1).astype(np.int64)
    cell = binned + np.arange(f) * bins
    z = np.full(n, start)
    features, limits, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, limit, value = [], [], []
        for level in range(depth):
            width = 2 ** level
            at = (node[:, None] * (f * bins) + cell).ravel()
            sums = [np.bincount(at, np.repeat(v, f), width * f * bins).reshape(width, f, bins).cumsum(2) for v in (g, h)]
            left_g, left_h = (s[:, :, :-1] for s in sums)
            all_g, all_h = (s[:, :1, -1:] for s in sums)
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = (left_g ** 2 / (left_h + SMOOTH) + right_g ** 2 / (right_h + SMOOTH)
                    - all_g ** 2 / (all_h + SMOOTH))
            gain[(left_h * 4 < LEAST) | (right_h * 4 < LEAST)] = 0
            flat = gain.reshape(width, -1)
            best = flat.argmax(1)
            split = flat[np.arange(width), best] > 1e-6
            j, b = np.where(split, best // (bins - 1), 0), np.where(split, best % (bins - 1), bins)
            feature.append(j)
            limit.append(np.asarray([edges[jj][bb] if s and bb < len(edges[jj]) else np.inf
                                     for jj, bb, s in zip(j, b, split)]))
            node = 2 * node + (binned[np.arange(n), j[node]] > b[node])
        sums = [np.bincount(node, v, 2 ** depth) for v in (g, h)]
        value = rate * sums[0] / (sums[1] + SMOOTH)
        z += value[node]
        features.append(np.concatenate(feature))
        limits.append(np.concatenate(limit))
        leaves.append(value)
    return empty | {"feature": np.stack(features), "limit": np.stack(limits), "leaf": np.stack(leaves)}


def score(x: np.ndarray, model: dict) -> np.ndarray:
    """Probability of label 1 per row: all rows walk all trees level by level."""
    z = np.full(len(x), model["start"])
    t = np.arange(len(model["leaf"]))[None, :]
    if len(x) and t.size:
        node = np.zeros((len(x), t.size), np.int64)
        rows = np.arange(len(x))[:, None]
        for level in range(model["depth"]):
            at = node + (2 ** level - 1)
            node = 2 * node + (x[rows, model["feature"][t, at]] > model["limit"][t, at])
        z = z + model["leaf"][t, node].sum(1)
    return 1 / (1 + np.exp(-z))


# ---------------------------------------------------------------- on Spark

def _statistics_batch(batch: pa.RecordBatch) -> np.ndarray:
    C.kept_by("quality", dict)  # drops what another operator left in this worker
    rows = [statistics(t) for t in batch.column("text").to_pylist()]
    return np.asarray(rows, np.float64).reshape(len(rows), len(NAMES))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, label: str = "quality") -> dict:
    """Trees from a bounded sample of labelled documents outside the held-out
    fold.  Only the sample's ids and labels are broadcast (16 bytes a row, at
    most ``2 * fit_rows`` rows), and only its statistics reach the driver."""
    C.ready(docs.sparkSession)
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y"))
              .filter("doc_id IS NOT NULL AND y IN (0, 1)").filter(C.fold(F.col("doc_id")) != 0))
    sample = C.write_once(C.bounded_sample(marked, "doc_id", fit_rows), "quality_sample")

    def run(batch):
        return pa.RecordBatch.from_arrays([batch.column("y"), pa.array(list(_statistics_batch(batch)),
                                                                       pa.list_(pa.float64()))], names=["y", "x"])
    rows = (C.texts(docs).join(F.broadcast(sample), "doc_id").select("y", "text")
            .mapInArrow(C.per_batch(run), "y double, x array<double>").limit(4 * fit_rows).collect())
    rows.sort(key=lambda r: (r.y, r.x))  # the same trees whatever the order of tasks
    x = np.asarray([r.x for r in rows], np.float64).reshape(len(rows), len(NAMES))
    return fit_trees(x, np.asarray([r.y for r in rows]))


def classify(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document; a narrow map."""
    def run(batch):
        p = score(_statistics_batch(batch), model)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(p),
                                           pa.array((p >= threshold).astype(np.int32))],
                                          names=["doc_id", "held_out", "score", "predicted"])
    held = F.coalesce(C.fold(F.col("doc_id")) == 0, F.lit(False))
    return C.texts(docs).withColumn("held_out", held).mapInArrow(C.per_batch(run), SCHEMA)


def kept(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with its columns, without the rows the classifier rejects."""
    def run(batch):
        C.kept_by("quality", dict)
        data = [None if t is None else t.encode() for t in batch.column("text").to_pylist()]
        x = np.asarray([statistics(t) for t in data], np.float64).reshape(len(data), len(NAMES))
        return batch.filter(pa.array(score(x, model) >= threshold))
    return docs.mapInArrow(C.per_batch(run), docs.schema)
