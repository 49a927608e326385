"""Importance resampling (11) against features spelled out one by one."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chirpflow.llm import importance as I

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or ""))


def features(text):
    w = words(text)
    return [zlib.crc32(f.encode()) % 10_000 for f in w + [a + " " + b for a, b in zip(w, w[1:])]]


def plain(docs, target):
    """``{(doc_id, n_features, weight, score, rank)}`` with repeats."""
    own, wanted = [features(t) for _, t in docs], [f for t in target for f in features(t)]
    s, t = np.bincount(sum(own, []), minlength=10_000), np.bincount(wanted, minlength=10_000)
    gain = [math.floor(1000 * math.log((int(t[b]) + 1) * (int(s.sum()) + 10_000) / ((int(s[b]) + 1) * (int(t.sum()) + 10_000))))
            for b in range(10_000)]
    rows = []
    for (doc_id, text), f in zip(docs, own):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))),
                     None, len(words(text))])
    part = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(part[:25 * len(part) // 100], 1):
        row[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=str)


def drawn(spark_docs, spark_target):
    out = I.resample(spark_docs, spark_target)
    return sorted((tuple(r) for r in out.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=700), st.lists(st.integers(0, 700), min_size=2, max_size=2))
def test_any_substring_s_crc_follows_from_two_prefixes(data, cut):
    a, b = sorted(min(c, len(data)) for c in cut)
    crc = I.running_crc(np.frombuffer(data, np.uint8))
    assert len(crc) == len(data) + 1
    got = crc[b:b + 1] ^ I.carried(crc[a:a + 1] ^ I.FULL, np.array([b - a])) ^ I.FULL
    assert int(got[0]) == zlib.crc32(data[a:b])


def test_long_substrings():
    data = random.Random(1).randbytes(300_000)
    crc = I.running_crc(np.frombuffer(data, np.uint8))
    for a, b in ((0, 300_000), (17, 299_999), (1, 70_000), (64, 128), (5, 5)):
        got = crc[b:b + 1] ^ I.carried(crc[a:a + 1] ^ I.FULL, np.array([b - a])) ^ I.FULL
        assert int(got[0]) == zlib.crc32(data[a:b])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abZ9 \né,.日{@[`", max_size=40), max_size=6), st.sampled_from([1 << 20, 30, 7]))
def test_features_whatever_the_pieces(texts, piece):
    got = [[0, []] for _ in texts]
    for rows, f in I.batch_features([t.encode() for t in texts], piece):
        for i, row in enumerate(rows):
            got[row][0] += int(f.words[i])
            got[row][1] += f.bucket[f.text == i].tolist()
    assert [(n, sorted(b)) for n, b in got] == [(len(words(t)), sorted(features(t))) for t in texts]


def test_resampling_equals_plain(edge, edge_rows, spark):
    target = [prose for _, prose, lang in edge_rows if lang == "de"] + [None, ""]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    want = plain([(d, t) for d, t, _ in edge_rows], target)
    assert drawn(edge, frame) == want and sum(r[4] is not None for r in want) > 5


def test_equal_scores_and_empty_tables(edge, empty, spark):
    rows = [(i % 4, "same words over and over again " * 6) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([(1, "same words")], "item_id long, text string")
    assert drawn(docs, target) == plain(rows, ["same words"])
    assert drawn(empty, target) == []
    none = target.limit(0)
    assert {r[2] for r in drawn(docs, none)} == {r[2] for r in plain(rows, [])}


@pytest.mark.parametrize("order", [1, 2, 7])
def test_the_draw_does_not_depend_on_the_layout(edge, edge_rows, spark, order):
    target = spark.createDataFrame([(1, edge_rows[0][1])], "item_id long, text string")
    assert drawn(edge.repartition(order), target) == plain([(d, t) for d, t, _ in edge_rows], [edge_rows[0][1]])
