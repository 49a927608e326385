"""Quality (3), language (9), language-model scores (4): closed forms, held-out accuracy, edge cases."""

import math
import zlib

import numpy as np

from chirpflow.llm import ctw, langid, quality

SF = "/root/testdata/sf0.01"


def held(doc_id, left):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == left


def test_trees_learn_and_walk_as_one_by_one():
    rng = np.random.default_rng(1)
    x = rng.random((600, len(quality.NAMES)))
    y = ((x[:, 3] > 0.5) ^ (x[:, 7] > 0.3)).astype(float)
    model = quality.fit_trees(x, y, trees=40)
    p = quality.score(x, model)
    assert ((p > 0.5) == y).mean() > 0.95
    for i in range(0, 600, 97):
        z = model["start"]
        for feature, limit, leaf in zip(model["feature"], model["limit"], model["leaf"]):
            node = 0
            for level in range(model["depth"]):
                at = node + 2 ** level - 1
                node = 2 * node + (x[i, feature[at]] > limit[at])
            z += leaf[node]
        assert math.isclose(p[i], 1 / (1 + math.exp(-z)))
    flat = quality.fit_trees(x, np.ones(600))
    assert np.allclose(quality.score(x, flat), 600.5 / 601)


def test_quality_held_out_and_edges(spark, edge, empty, edge_rows):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.classify(docs, quality.fit(docs, labels)).collect()}
    marks = {r.doc_id: r.quality for r in labels.collect()}
    rows = [(got[d], q) for d, q in marks.items() if held(d, 0)]
    assert len(rows) > 50 and sum(r.predicted == q for r, q in rows) / len(rows) > 0.95
    assert all(r.held_out == held(r.doc_id, 0) for r in got.values())
    none = labels.filter("false")
    model = quality.fit(edge, none)
    got = quality.classify(edge, model).collect()
    assert len(got) == len(edge_rows) and {r.score for r in got} == {0.5} and all(r.predicted == 1 for r in got)
    assert quality.classify(empty, model).collect() == []
    assert quality.kept(edge, model).count() == len(edge_rows) and quality.kept(edge, model).columns == edge.columns


def test_kneser_ney_sums_to_one_and_matches_a_plain_version():
    texts = [b"the cat sat on the mat", b"a cat and a hat", b"that that"]
    counts = {}
    for t in texts:
        for g, n in langid.grams_of([t]).items():
            counts[g] = counts.get(g, 0) + n
    assert counts == langid.grams_of(texts)
    letters = sorted({c for g in counts for c in g})
    model = langid.kneser_ney(counts, len(letters) + 1)
    tables = [counts]
    while len(next(iter(tables[-1]))) > 1:
        lower = {}
        for g in tables[-1]:
            lower[g[1:]] = lower.get(g[1:], 0) + 1
        tables.append(lower)

    def plain(gram):
        if not gram:
            return 1 / (len(letters) + 1)
        own = tables[langid.ORDER - len(gram)]
        ones, twos = (sum(v == k for v in own.values()) for k in (1, 2))
        d = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
        total = sum(v for g, v in own.items() if g[:-1] == gram[:-1])
        if not total:
            return plain(gram[1:])
        kinds = sum(g[:-1] == gram[:-1] for g in own)
        return max(own.get(gram, 0) - d, 0) / total + d * kinds / total * plain(gram[1:])
    for context in ("the", " ca", "zzz", "atz"):
        rows = np.array([[ord(c) for c in context + x] for x in letters], np.uint32)
        p = np.exp(langid.log_probabilities(rows, model, len(letters) + 1))
        assert np.allclose(p, [plain(context + x) for x in letters])
        assert p.sum() <= 1 + 1e-9


def test_language_held_out_and_edges(spark, edge, empty, edge_rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    langs = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = [(got[d].lang_pred, g) for d, g in langs.items() if held(d, 0)]
    assert len(rows) > 100 and sum(a == b for a, b in rows) / len(rows) > 0.95
    assert sum(r.rejected for r in got.values()) < 0.02 * len(got)
    own = langid.identify(edge).collect()
    assert len(own) == len(edge_rows)
    for r in own:
        text = next(t for d, t, _ in edge_rows if d == r.doc_id)
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (text is None or not any(c.isalpha() for c in text))
        assert 0 <= r.score <= 1 and r.lang_pred in ("en", "de", "und")
    assert langid.identify(empty).collect() == []
    assert {r.lang_pred for r in langid.identify(edge, train=empty).collect()} == {"und"}
    assert langid.kept(edge, train=edge).columns == edge.columns


def test_rare_languages_are_learned_and_keep_clean_texts(spark):
    words = {"en": ["the", "cat", "with", "this", "thing"], "xx": ["qoqa", "zuzi", "qaqu", "zizo"], "yy": ["ñoñu"]}
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(words["en"], 6)), "en") for i in range(30_000)]
    rows += [(40_000 + i, " ".join(rng.choice(words["xx"], 6)), "xx") for i in range(8)] + [(50_000, "ñoñu ñu", "yy")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = langid.fit(docs)
    assert model["languages"] == ["en", "xx", "yy"] and model["limits"].keys() == {"en", "xx", "yy"}
    got = langid.predict([b"qoqa zizo", "ñoñu".encode(), b"the cat with this thing the"], model)
    assert [r[0] for r in got] == ["xx", "yy", "en"] and not got[0][3] and not got[2][3]
    picked = {r.lang: r["count"] for r in langid.labelled(docs).filter("counted").groupBy("lang").count().collect()}
    assert 0.9 < picked["en"] / langid.LANG_DOCS < 1.1 and picked["yy"] == 1


def test_blocks_of_characters_do_not_change_the_result(monkeypatch):
    texts = [b"the cat sat", None, b"", "größe und maß".encode(), b"x" * 500]
    counts = {"en": langid.grams_of([b"the cat sat on the mat"]), "de": langid.grams_of(["die größe".encode()])}
    model = {"languages": ["de", "en"], "alphabet": 30,
             "models": {k: langid.kneser_ney(v, 30) for k, v in counts.items()}}
    whole = langid.cross_entropies(texts, model)
    monkeypatch.setattr(langid, "BLOCK", 7)
    parts = langid.cross_entropies(texts, model)
    assert np.allclose(whole[0], parts[0]) and (whole[1] == parts[1]).all()


def plain_ctw(train, texts, depth):
    """Context-tree weighting by recursion over dictionaries."""
    end = bytes([ctw.END])
    nodes = {}
    for t in train:
        s = end * depth + t.lower() + end
        for i in range(depth, len(s)):
            for bit in range(8):
                known, one = (1 << bit) | (s[i] >> (8 - bit)), (s[i] >> (7 - bit)) & 1
                for d in range(depth + 1):
                    nodes.setdefault((s[i - d:i], known), [0, 0])[one] += 1

    def kt(n):
        return math.lgamma(n[0] + .5) + math.lgamma(n[1] + .5) - math.lgamma(sum(n) + 1) - math.log(math.pi)
    children = {}
    for context, known in nodes:
        if context:
            children.setdefault((context[1:], known), []).append((context, known))
    weighted = {}
    for key in sorted(nodes, key=lambda k: -len(k[0])):
        own = kt(nodes[key])
        if len(key[0]) == depth:
            weighted[key] = own
        else:
            weighted[key] = np.logaddexp(own, sum(weighted[c] for c in children[key])) - math.log(2)

    def one(context, known, d):
        key = (context[len(context) - d:], known)
        n = nodes.get(key, [0, 0])
        p = (n[1] + .5) / (sum(n) + 1)
        if d == depth:
            return p
        w = math.exp(kt(n) - weighted.get(key, 0.0) - math.log(2)) if key in nodes else 0.5
        return w * p + (1 - w) * one(context, known, d + 1)
    out = []
    for t in texts:
        s, total = end * depth + t.lower() + end, 0.0
        for i in range(depth, len(s)):
            for bit in range(8):
                p = one(s[i - depth:i], (1 << bit) | (s[i] >> (8 - bit)), 0)
                total += math.log10(p if (s[i] >> (7 - bit)) & 1 else 1 - p)
        out.append(total)
    return out


def test_scores_equal_a_plain_context_tree(spark):
    rows = [(i, t) for i, t in enumerate(["the cat sat", "The hat", "", None, "cats été", "the the the cat", "zzz",
                                          "a hat on the mat", "the cat sat", "unseen words"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in ctw.score_texts(docs, shards=3).collect()}
    train = [(t or "").encode() for i, t in rows if not held(i, 1)]
    want = plain_ctw(train, [(t or "").encode() for _, t in rows], ctw.DEPTH)
    tokens = [w for t in train for w in [*t.lower().split(), "end"]]
    kinds = {w: tokens.count(w) for w in tokens}
    for (i, t), score in zip(rows, want):
        own = [*(t or "").encode().lower().split(), "end"]
        r = got[i]
        assert math.isclose(r.score, score, rel_tol=1e-7) and r.held_out == held(i, 1)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(w in kinds for w in own), len(tokens))
        base = sum(math.log10((kinds.get(w, 0) + .5) / (len(tokens) + .5 * (len(kinds) + 1))) for w in own)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)


def test_blocks_and_groups_do_not_change_scores(spark, monkeypatch):
    rows = [(i, f"the cat {i} sat on mat {i % 7}" * (1 + i % 3)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    whole = {r.doc_id: r for r in ctw.score_texts(docs, shards=4).collect()}
    monkeypatch.setattr(ctw, "BLOCK_BYTES", 300)
    monkeypatch.setattr(ctw, "GROUP", 4)
    monkeypatch.setattr(ctw, "CHUNK", 100)
    for r in ctw.score_texts(docs, shards=4).collect():
        w = whole[r.doc_id]
        assert math.isclose(r.score, w.score, rel_tol=1e-9) and math.isclose(r.base_score, w.base_score, rel_tol=1e-9)
        assert (r.n_known, r.train_tokens, r.n_bytes) == (w.n_known, w.train_tokens, w.n_bytes)


def test_next_byte_probabilities_sum_to_one():
    grams, counts = ctw.count_grams([b"the cat sat on the mat", b"the hat"], [])
    ctx = grams[5] >> np.uint64(8)
    every = np.union1d(grams, (ctx << np.uint64(8)) | np.arange(256, dtype=np.uint64))
    n = np.zeros(len(every), np.int64)
    n[np.searchsorted(every, grams)] = counts
    logs = ctw.log_probabilities(every, ctw.subtrees(every, n, 0), lambda b, k: (np.zeros(len(k)), np.ones(len(k))))
    assert math.isclose((10 ** logs[every >> np.uint64(8) == ctx]).sum(), 1.0, rel_tol=1e-9)


def test_ctw_edges(edge, empty, edge_rows, monkeypatch):
    got = ctw.score_texts(edge).collect()
    assert len(got) == len(edge_rows) and all(r.score < 0 for r in got)
    assert ctw.score_texts(empty).collect() == []
    x = np.array([0.5, 1.0, 3.5, 1e3, 1e9])
    assert np.allclose(ctw.lgamma(x), [math.lgamma(v) for v in x], rtol=1e-11, atol=1e-11)
