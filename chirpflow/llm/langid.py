"""Language identification by interpolated Kneser-Ney character models.

One model per language, of order four, over lower-cased letters (every run of
other characters is one space).  Each order is held as sorted arrays: hashes of
the n-grams with their interpolated probabilities, and hashes of the contexts
with their back-off weights.  A text gets the language with the lowest cross-entropy per
character.  The n-grams are counted on a sample bounded per language, so that a
rare language is learned however large the table is.  The temperature that turns
cross-entropies into a score, and each language's rejection limit, are calibrated
on all labelled documents that the counts have not seen.

Edge cases: a NULL text, or one without a letter, is ``und`` with score 0 and
rejected; if no labelled text exists, all are ``und``; ties go to the language
that sorts first; very long texts are read whole, in blocks; equal rows get
equal results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

ORDER = 4
LANG_DOCS = 2000         # about so many documents of each language are counted, all of a rarer one
LIMIT_DOCS = 50          # a language with fewer calibration documents is only rejected beyond a uniform guess, or its own limit
TEMPERATURES = np.geomspace(0.5, 200, 40)
BLOCK = 1 << 20          # characters worked on at once
HASH = np.uint64(0x9E3779B97F4A7C15)
SLACK = 1.25             # a rejected text is this much harder than the hardest calibration texts

SCHEMA = ("doc_id long, held_out boolean, lang_pred string, score double, cross_entropy double, "
          "rejected boolean, n_letters long")


def _folding() -> np.ndarray:
    table = np.full(0x110000, 32, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            table[cp] = ord(low[0]) if low[0].isalpha() else cp
    return table


def folding() -> np.ndarray:
    """Code point to lower-case letter; 32 for whatever is no letter."""
    return C.kept_by("langid", _folding)


def letters(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded characters of all texts with one space between and around words,
    each text's number of characters there, and its number of letters."""
    chars, sizes, counts = [], [], []
    fold = folding()
    for t in texts:
        cp = np.frombuffer((t or b"").decode().encode("utf-32-le"), "<u4")
        low = fold[cp]
        blank = low == 32
        low = low[~(blank & np.r_[True, blank[:-1]])] if len(low) else low
        chars.append(np.r_[np.uint32(32), low])
        sizes.append(len(low) + 1)
        counts.append(int(len(blank) - blank.sum()))
    return (np.concatenate(chars) if chars else np.zeros(0, np.uint32)), np.asarray(sizes), np.asarray(counts)


def hashes(chars: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` characters that end at each place from ``order - 1`` on."""
    n = len(chars) - order + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(order):
        out = (out + chars[k:k + max(n, 0)].astype(np.uint64) + np.uint64(1)) * HASH
    return out


def grams_of(texts: list[bytes | None]) -> dict[str, int]:
    """Counts of the character n-grams of the highest order, each text by itself."""
    chars, sizes, _ = letters(texts)
    counts: dict[str, int] = {}
    at = 0
    for n in sizes.tolist():
        one = chars[at:at + n]
        at += n
        if n < ORDER:
            continue
        windows = np.lib.stride_tricks.sliding_window_view(one, ORDER)
        uniq, c = np.unique(windows, axis=0, return_counts=True) if n < 64 else _unique_rows(windows)
        for row, k in zip(uniq.tolist(), c.tolist()):
            key = "".join(map(chr, row))
            counts[key] = counts.get(key, 0) + k
    return counts


def _unique_rows(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code = np.zeros(len(windows), np.uint64)
    for k in range(ORDER):
        code = (code + windows[:, k].astype(np.uint64) + np.uint64(1)) * HASH
    _, first, counts = np.unique(code, return_index=True, return_counts=True)
    return windows[first], counts


def kneser_ney(counts: dict[str, int], alphabet: int) -> list[dict]:
    """Per order from 1 up: sorted hashes of n-grams with probabilities, sorted
    hashes of contexts with back-off weights.  Lower orders count distinct
    left neighbours (continuation counts); the last back-off is uniform."""
    by_order = [None] * ORDER
    by_order[ORDER - 1] = counts
    for k in range(ORDER - 1, 0, -1):
        lower: dict[str, int] = {}
        for g in by_order[k]:
            lower[g[1:]] = lower.get(g[1:], 0) + 1
        by_order[k - 1] = lower
    out, below = [], {}
    for k, own in enumerate(by_order, start=1):
        ones, twos = (sum(1 for v in own.values() if v == x) for x in (1, 2))
        discount = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
        total: dict[str, int] = {}
        kinds: dict[str, int] = {}
        for g, v in own.items():
            total[g[:-1]] = total.get(g[:-1], 0) + v
            kinds[g[:-1]] = kinds.get(g[:-1], 0) + 1
        weight = {h: discount * kinds[h] / total[h] for h in total}
        p = {g: (v - discount) / total[g[:-1]] + weight[g[:-1]] * (below[g[1:]] if k > 1 else 1 / alphabet)
             for g, v in own.items()}
        below = p
        out.append({"grams": _sorted(p, k), "contexts": _sorted(weight, k - 1)})
    return out


def _sorted(values: dict[str, float], order: int) -> tuple[np.ndarray, np.ndarray]:
    keys = list(values)
    if order:
        cp = np.frombuffer("".join(keys).encode("utf-32-le"), "<u4").reshape(-1, order)
        h = np.zeros(len(keys), np.uint64)
        for k in range(order):
            h = (h + cp[:, k].astype(np.uint64) + np.uint64(1)) * HASH
    else:
        h = np.zeros(len(keys), np.uint64)
    at = np.argsort(h, kind="stable")
    return h[at], np.asarray([values[k] for k in keys])[at]


def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    known, values = table
    if not len(known):
        return np.zeros(len(keys), bool), np.ones(len(keys))
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return known[at] == keys, values[at]


def log_probabilities(windows: np.ndarray, model: list[dict], alphabet: int) -> np.ndarray:
    """Natural log of the last character's probability given those before it, per row."""
    p = np.full(len(windows), 1 / alphabet)
    for k in range(1, ORDER + 1):
        own = hashes_of_rows(windows[:, ORDER - k:])
        seen, value = _find(model[k - 1]["grams"], own)
        ctx, weight = _find(model[k - 1]["contexts"], hashes_of_rows(windows[:, ORDER - k:-1]))
        p = np.where(seen, value, np.where(ctx, weight, 1.0) * p)
    return np.log(p)


def hashes_of_rows(rows: np.ndarray) -> np.ndarray:
    h = np.zeros(len(rows), np.uint64)
    for k in range(rows.shape[1]):
        h = (h + rows[:, k].astype(np.uint64) + np.uint64(1)) * HASH
    return h


def cross_entropies(texts: list[bytes | None], model: dict) -> tuple[np.ndarray, np.ndarray]:
    """``(texts, languages)`` cross-entropies in nats per character, and letters per text."""
    names = model["languages"]
    chars, sizes, counts = letters(texts)
    ends = np.cumsum(sizes)
    chars = np.concatenate([np.full(ORDER - 1, 32, np.uint32), chars])
    n = len(chars) - ORDER + 1
    total = np.zeros((len(texts), len(names)))
    for a in range(0, n, BLOCK):
        b = min(n, a + BLOCK)
        block = chars[a:b + ORDER - 1]
        windows = np.lib.stride_tricks.sliding_window_view(block, ORDER)
        _, first, back = np.unique(hashes(block, ORDER), return_index=True, return_inverse=True)
        owner = np.searchsorted(ends, np.arange(a, b), side="right")
        rows = windows[first]
        for l, name in enumerate(names):
            logp = log_probabilities(rows, model["models"][name], model["alphabet"])
            total[:, l] += np.bincount(owner, logp[back], minlength=len(texts))
    return -total / np.maximum(sizes, 1)[:, None], counts


def labelled(docs: DataFrame, lang_col: str = "lang", lang_docs: int = LANG_DOCS) -> DataFrame:
    """``(lang, text, counted)`` of the labelled documents.  A fifth is left for
    calibration; of the rest, a hash picks about ``lang_docs`` of each language.
    A language that has documents in that fifth only is counted on these."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col("text").cast("binary").alias("text"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    left = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(5)) == 0
    pick = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    sizes = rows.groupBy("lang").agg(F.count(F.when(~left, 1)).alias("n")).select(
        "lang", (F.lit(lang_docs) / F.greatest("n", F.lit(1)) * (1 << 30)).alias("share"), (F.col("n") == 0).alias("few"))
    return rows.join(F.broadcast(sizes), "lang").select(
        "lang", "text", (F.col("few") | ~left & (pick < F.col("share"))).alias("counted"))


def fit(docs: DataFrame, lang_docs: int = LANG_DOCS, lang_col: str = "lang") -> dict:
    """Models from a sample bounded per language, counted by Spark, and their
    calibration on all other labelled documents."""
    rows = labelled(docs, lang_col, lang_docs)

    def count(batch):
        out = []
        langs, data = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        for lang in sorted(set(langs)):
            own = grams_of([t for t, x in zip(data, langs) if x == lang])
            out += [(lang, g, n) for g, n in own.items()]
        cols = list(zip(*out)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()),
                                           pa.array(cols[2], pa.int64())], names=["lang", "gram", "n"])
    counted = (rows.filter("counted").select("lang", "text").mapInArrow(C.per_batch(count), "lang string, gram string, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    per: dict[str, dict[str, int]] = {}
    for lang, gram, n in zip(counted["lang"], counted["gram"], counted["n"]):
        per.setdefault(lang, {})[gram] = int(n)
    alphabet = len({c for own in per.values() for g in own for c in g}) + 1
    model = {"languages": sorted(per), "alphabet": alphabet, "temperature": 1.0, "limits": {},
             "models": {lang: kneser_ney(own, alphabet) for lang, own in per.items()}}
    if not per:
        return model
    shared = docs.sparkSession.sparkContext.broadcast(model)

    names = model["languages"]

    def measure(batch):
        """Each text's cross-entropy in its own language; log likelihoods per temperature are summed up
        on a batch's first row."""
        h, n = cross_entropies(batch.column("text").to_pylist(), shared.value)
        at = {name: i for i, name in enumerate(names)}
        y = np.asarray([at.get(lang, -1) for lang in batch.column("lang").to_pylist()])
        ok = (n > 0) & (y >= 0)
        h, y = h[ok], y[ok]
        sums = [log_likelihoods(h, y).tolist()] + [None] * (len(y) - 1) if len(y) else []
        return pa.RecordBatch.from_arrays(
            [pa.array([names[k] for k in y], pa.string()), pa.array(h[np.arange(len(y)), y], pa.float64()),
             pa.array(sums, pa.list_(pa.float64()))], names=["lang", "own", "ll"])
    seen = (rows.filter("NOT counted").select("lang", "text")
            .mapInArrow(C.per_batch(measure, 4 << 20), "lang string, own double, ll array<double>")
            .rollup("lang").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("own", 0.999, 100_000).alias("high"),
                                F.array(*(F.sum(F.col("ll")[i]) for i in range(len(TEMPERATURES)))).alias("ll")).collect())
    return model | calibrate(names, {r.lang: r for r in seen if r.n}, alphabet)


def log_likelihoods(h: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sum over texts of the label's log probability, per temperature."""
    out = []
    for t in TEMPERATURES:
        z = -t * h
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        out.append(np.log(np.maximum((p / p.sum(1, keepdims=True))[np.arange(len(y)), y], 1e-4)).sum())
    return np.asarray(out)


def calibrate(names: list[str], seen: dict, alphabet: int) -> dict:
    """The temperature with the highest likelihood of the labels, and per language
    the cross-entropy above which a text is rejected.  ``seen`` has number of texts,
    quantile and likelihoods per language, and under None those of all."""
    if not seen:
        return {"temperature": 10.0, "limits": {name: math.log(alphabet) for name in names}}
    limits = {}
    for name in names:
        own = seen.get(name)
        limits[name] = own.high * SLACK if own else 0.0
        if not own or own.n < LIMIT_DOCS:  # too few to know how hard its texts can be
            limits[name] = max(limits[name], math.log(alphabet))
    return {"temperature": float(TEMPERATURES[int(np.argmax(seen[None].ll))]), "limits": limits}


def predict(texts: list[bytes | None], model: dict) -> list[tuple[str, float, float | None, bool, int]]:
    """``(language, score, cross-entropy, rejected, letters)`` per text."""
    names = model["languages"]
    if not names or not texts:
        return [("und", 0.0, None, True, 0) for _ in texts]
    h, counts = cross_entropies(texts, model)
    z = -model["temperature"] * h
    z -= z.max(1, keepdims=True)
    p = np.exp(z)
    p /= p.sum(1, keepdims=True)
    best = h.argmin(1)
    out = []
    for i, k in enumerate(best.tolist()):
        if not counts[i]:
            out.append(("und", 0.0, None, True, 0))
            continue
        limit = model["limits"].get(names[k], math.inf)
        out.append((names[k], float(p[i, k]), float(h[i, k]), bool(h[i, k] > limit), int(counts[i])))
    return out


def identify(docs: DataFrame, train: DataFrame | None = None, model: dict | None = None) -> DataFrame:
    """One row per document.  ``train`` (default: ``docs`` outside the held-out
    fold, crc32 of the id mod 5 = 0) needs ``doc_id, text, lang``."""
    C.ready(docs.sparkSession)
    train = docs.filter(C.fold(F.col("doc_id")) != 0) if train is None else train
    shared = docs.sparkSession.sparkContext.broadcast(fit(train) if model is None else model)

    def run(batch):
        rows = predict(batch.column("text").to_pylist(), shared.value)
        cols = list(zip(*rows)) or [()] * 5
        types = (pa.string(), pa.float64(), pa.float64(), pa.bool_(), pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"),
                                           *(pa.array(c, t) for c, t in zip(cols, types))],
                                          names=["doc_id", "held_out", "lang_pred", "score", "cross_entropy",
                                                 "rejected", "n_letters"])
    held = F.coalesce(C.fold(F.col("doc_id")) == 0, F.lit(False))
    return (C.texts(docs).withColumn("held_out", held)
            .mapInArrow(C.per_batch(run, 4 << 20), SCHEMA))


def kept(docs: DataFrame, train: DataFrame, model: dict | None = None) -> DataFrame:
    """``docs`` with its columns, without the rejected rows."""
    C.ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(train) if model is None else model)

    def run(batch):
        rows = predict([None if t is None else t.encode() for t in batch.column("text").to_pylist()], shared.value)
        return batch.filter(pa.array([not r[3] for r in rows], pa.bool_()))
    return docs.mapInArrow(C.per_batch(run, 4 << 20), docs.schema)
