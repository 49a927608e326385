"""Features and models: closed forms, accuracy bounds, persistence, layout
independence."""

import math

import pytest
from pyspark.sql import functions as F

from chirpflow.operators import features as FT
from chirpflow.operators import models as M
from chirpflow.operators import prepare as P
from chirpflow.plans import queries as Q
from chirpflow.session import scratch_path
from chirpflow.sinks.tables import save_model
from chirpflow.sources.models import load_model
from conftest import SF_MID


@pytest.fixture(scope="module")
def split(spark):
    labelled = Q._labelled(spark, SF_MID).cache()
    train, test = P.hash_split(labelled)
    return labelled, train, test


@pytest.fixture(scope="module")
def models(split):
    _, train, _ = split
    return M.fit_models(train, FT.ENGLISH, ("lr", "nb"))


def test_hash_split_is_stable_under_repartition(split):
    labelled, train, _ = split
    a = {r[0] for r in train.select("doc_id").collect()}
    b = {r[0] for r in P.hash_split(labelled.repartition(3))[0].select("doc_id").collect()}
    assert a == b and 0.7 < len(a) / labelled.count() < 0.9


def test_idf_matches_fitted_model(spark, split, models):
    _, train, _ = split
    ours = {r.term: r.idf for r in FT.idf_weights(train).collect()}
    stages = models["nb"].stages
    vocab = stages[2].vocabulary
    idf = stages[3].idf.toArray()
    assert len(vocab) == len(ours)
    for term, w in zip(vocab, idf):
        assert math.isclose(ours[term], w, rel_tol=1e-9, abs_tol=1e-12)


def test_nb_closed_form_matches_mllib(split, models):
    _, train, _ = split
    nb = models["nb"].stages[-1]
    vocab = models["nb"].stages[2].vocabulary
    pri = {r.label: r.log_pi for r in M.nb_priors(FT.ENGLISH.prepare(train)).collect()}
    for label, value in enumerate(nb.pi.toArray()):
        assert math.isclose(pri[label], value, rel_tol=1e-9)
    theta = nb.theta.toArray()
    index = {t: i for i, t in enumerate(vocab)}
    rows = M.nb_parameters(train).collect()
    assert rows
    for r in rows:
        assert math.isclose(theta[r.label][index[r.term]], r.log_theta, rel_tol=1e-9)


def test_accuracies_are_sane(split, models):
    _, _, test = split
    majority = test.agg(F.avg("label")).first()[0]
    for name in ("lr", "nb"):
        pred = M.score_texts(test, models[name])
        acc = M.accuracy(pred, name).first().value
        assert math.isclose(acc, M.evaluate(pred, "accuracy"), rel_tol=1e-12)
        assert acc >= min(majority, 1 - majority) - 1e-9
        assert 0.0 <= M.evaluate(pred, "areaUnderROC") <= 1.0


def test_comparison_frame(split, models):
    _, _, test = split
    preds = {n: M.score_texts(test, models[n]) for n in ("lr", "nb")}
    rows = M.compare_models(preds).collect()
    assert [r.model for r in rows] == ["lr", "nb"]
    assert {r.metric for r in rows} == {"accuracy"}


def test_save_load_roundtrip_same_predictions(spark, split, models):
    _, _, test = split
    path = save_model(models["nb"], scratch_path(spark, "test-models", "nb"))
    a = {tuple(r) for r in M.score_texts(test, models["nb"]).select("doc_id", "prediction").collect()}
    b = {tuple(r) for r in M.score_texts(test, load_model(path)).select("doc_id", "prediction").collect()}
    assert a == b


def test_predictions_independent_of_layout(split):
    _, train, test = split
    m1 = M.fit_models(train, FT.ENGLISH, ("nb",))["nb"]
    m2 = M.fit_models(train.repartition(5), FT.ENGLISH, ("nb",))["nb"]
    a = {tuple(r) for r in M.score_texts(test, m1).select("doc_id", "prediction").collect()}
    b = {tuple(r) for r in M.score_texts(test, m2).select("doc_id", "prediction").collect()}
    assert a == b


def test_custom_texts_scored_with_training_preparation(spark, models):
    from chirpflow.sources.files import texts_frame
    df = texts_frame(spark, ["I hate you", "2 good 4 you", None])
    out = M.score_texts(df, models["lr"]).select("text", "prediction").collect()
    assert [r.text for r in out] == ["I hate you", " good  you"]
    assert all(r.prediction in (0.0, 1.0) for r in out)


def test_whitespace_profile_tokens(spark):
    df = spark.createDataFrame([("زه  تا نه",)], "text string")
    words = FT.tokenize(df, FT.WHITESPACE).first().words
    assert words == "زه  تا نه"[::-1].split()


def test_tree_classifier_option(split):
    _, train, test = split
    m = M.fit_models(train, FT.ENGLISH, ("dt",))["dt"]
    assert M.score_texts(test, m).count() == test.count()


def test_vocabulary_topk_ties_by_term(spark):
    stats = spark.createDataFrame([("b", 3, 1), ("a", 3, 1), ("c", 5, 2), ("d", 1, 1)],
                                  "term string, tf long, df long")
    assert [r.term for r in FT.vocabulary_topk(stats, 3).collect()] == ["c", "a", "b"]


def test_string_indexer_labels(split):
    from chirpflow.operators.prepare import index_labels
    labelled, _, _ = split
    model, indexed = index_labels(labelled.drop("label"))
    majority = labelled.groupBy("sentiment").count().orderBy(F.desc("count")).first().sentiment
    assert model.labels[0] == majority
    row = indexed.filter(F.col("sentiment") == majority).first()
    assert row.label == 0.0


def test_term_stats_and_tfidf_independent_of_layout(split):
    labelled, _, _ = split
    fit = P.split_bucket("doc_id") < 80
    a = {tuple(r) for r in FT.term_stats(labelled).collect()}
    b = {tuple(r) for r in FT.term_stats(labelled.repartition(3).orderBy(F.rand(1))).collect()}
    assert a == b
    w1 = {(r.doc_id, r.term): r.weight for r in FT.tfidf_terms(labelled, fit=fit).collect()}
    w2 = {(r.doc_id, r.term): r.weight
          for r in FT.tfidf_terms(labelled.repartition(5), fit=fit).collect()}
    assert w1.keys() == w2.keys()
    assert all(math.isclose(w1[k], w2[k], rel_tol=1e-12) for k in w1)


def test_unicode_profile_keeps_accented_words(spark):
    df = spark.createDataFrame([("Café au lait, ça va",)], "text string")
    ascii_words = FT.tokenize(df, FT.ENGLISH).first().words
    uni = FT.Profile("english", tokens_col="filtered", unicode=True)
    unicode_words = FT.tokenize(df, uni).first().words
    assert "caf" in ascii_words and "café" in unicode_words and "ça" in unicode_words


def test_label_sort_orders_by_label_and_spreads(split):
    labelled, _, _ = split
    out = P.label_sort(labelled.select("doc_id", "label"))
    labels = [r.label for r in out.collect()]
    assert labels == sorted(labels)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "doc_id" in plan.split("rangepartitioning")[1].split(")")[0]


def test_score_all_equals_separate_scoring(split, models):
    _, _, test = split
    both = M.score_all(test, models).select("doc_id", "prediction_lr", "prediction_nb")
    got = {r.doc_id: (r.prediction_lr, r.prediction_nb) for r in both.collect()}
    for i, name in enumerate(("lr", "nb")):
        sep = M.score_texts(test, models[name]).select("doc_id", "prediction").collect()
        assert {r.doc_id: r.prediction for r in sep} == {k: v[i] for k, v in got.items()}
    acc = {r.model: r.value for r in M.accuracies(M.score_all(test, models), ["lr", "nb"]).collect()}
    for name in ("lr", "nb"):
        assert math.isclose(acc[name], M.evaluate(M.score_texts(test, models[name])), rel_tol=1e-12)


def test_train_sentiment_job(spark):
    docs = Q._docs(spark, SF_MID).select("doc_id", "text")
    labels = Q.read_table(spark, SF_MID, "labels")
    pos = docs.join(labels.filter("quality = 1").select("doc_id"), "doc_id")
    neg = docs.join(labels.filter("quality = 0").select("doc_id"), "doc_id")
    out = scratch_path(spark, "test-train")
    models, comparison = M.train_sentiment(pos, neg, model_dir=out)
    rows = {r.model: r.value for r in comparison.collect()}
    assert set(rows) == {"lr", "nb"} and all(0.0 <= v <= 1.0 for v in rows.values())
    assert load_model(out + "/nb").stages[-1].numClasses == 2


def test_feature_pipeline_matches_fitted_feature_stages(split, models):
    _, train, _ = split
    fitted = FT.feature_pipeline(FT.ENGLISH).fit(FT.ENGLISH.prepare(train))
    assert set(fitted.stages[2].vocabulary) == set(models["nb"].stages[2].vocabulary)


def test_idf_table_is_capped_like_the_vectorizer(spark, split):
    from pyspark.ml.feature import IDF, CountVectorizer
    _, train, _ = split
    small = FT.Profile("english", tokens_col="filtered", stop_words=FT.ENGLISH.stop_words,
                       vocab_size=50)
    idf = {r.term: r.idf for r in FT.idf_weights(train, small, vocab_size=50).collect()}
    assert len(idf) == 50
    tokens = FT.tokenize(train, small).select("filtered")
    counts = {r.term: r.n for r in tokens.select(F.explode("filtered").alias("term"))
              .groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(idf) == set(sorted(counts, key=lambda t: (-counts[t], t))[:50])
    cv = CountVectorizer(inputCol="filtered", outputCol="f", vocabSize=50).fit(tokens)
    mllib = dict(zip(cv.vocabulary, IDF(inputCol="f", outputCol="w").fit(cv.transform(tokens))
                     .idf.toArray()))
    shared = set(idf) & set(mllib)
    assert len(shared) >= 45
    assert all(math.isclose(idf[t], mllib[t], rel_tol=1e-9) for t in shared)
    rows = FT.tfidf_terms(train, small, vocab_size=50).select("term").distinct().collect()
    assert {r.term for r in rows} <= set(idf)


def test_random_split_partitions_rows(split):
    labelled, _, _ = split
    base = labelled.select("doc_id", "label").coalesce(2)
    train, test = P.random_split(base)
    a = [r.doc_id for r in train.collect()]
    b = [r.doc_id for r in test.collect()]
    assert not set(a) & set(b) and sorted(a + b) == sorted(r.doc_id for r in base.collect())
    assert 0.7 < len(a) / (len(a) + len(b)) < 0.9
    again = [r.doc_id for r in P.random_split(base)[0].collect()]
    assert sorted(again) == sorted(a)


def test_lr_fit_is_deterministic(split):
    _, train, test = split
    runs = []
    for _ in range(2):
        lr = M.fit_models(train, FT.ENGLISH, ("lr",))["lr"]
        runs.append({r.doc_id: r.prediction
                     for r in M.score_texts(test, lr).select("doc_id", "prediction").collect()})
    assert runs[0] == runs[1]


def test_unknown_labels_are_no_class(spark, split):
    _, train, test = split
    odd = train.limit(20).withColumn("label", F.when(F.col("doc_id") % 2 == 0, F.lit(7)))
    a = M.fit_models(train, FT.ENGLISH, ("nb",))["nb"]
    b = M.fit_models(train.unionByName(odd), FT.ENGLISH, ("nb",))["nb"]
    assert a.stages[-1].pi.toArray().tolist() == b.stages[-1].pi.toArray().tolist()
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None)], "doc_id long, quality int")
    got = {r.doc_id: r.sentiment for r in P.attach_labels(rows, labels).collect()}
    assert got == {1: "Positive", 2: "Negative", 3: None}


def test_split_gives_rows_without_a_key_a_side(spark):
    rows = spark.createDataFrame([(None,), (None,), (1,), (2,), (3,)], "doc_id long")
    train, test = P.hash_split(rows)
    sides = {r.side for r in P.with_split_side(rows).filter("doc_id IS NULL").collect()}
    assert train.count() + test.count() == 5 and sides == {"test"} and test.filter("doc_id IS NULL").count() == 2


def test_vectorizer_has_the_counted_vocabulary(split):
    _, train, _ = split
    from pyspark.ml.feature import CountVectorizer
    tokens = FT.tokenize(train, FT.ENGLISH)
    small = FT.Profile("english", tokens_col="filtered", stop_words=FT.ENGLISH.stop_words, vocab_size=500)
    own = FT.vectorizer(tokens, small).vocabulary
    plain = CountVectorizer(inputCol="filtered", outputCol="f", vocabSize=500).fit(tokens).vocabulary
    stats = FT.term_stats(train).orderBy(F.desc("tf"), "term").limit(500).collect()
    assert own == [r.term for r in stats]
    tf = {r.term: r.tf for r in FT.term_stats(train).collect()}
    assert [tf[t] for t in own] == [tf[t] for t in plain]  # MLlib leaves ties open


def test_vocabulary_cut_at_every_place(spark):
    rows = [(f"{a}{b}", f) for f in (1, 2, 5) for a in ("aaaa", "aaab", "b") for b in range(f, f + 4)]
    stats = spark.createDataFrame(rows, "term string, tf long").dropDuplicates(["term"]).cache()
    n = stats.count()
    for k in (1, 2, 5, 9, n - 1, n, n + 5):
        want = [r.term for r in stats.orderBy(F.desc("tf"), "term").limit(k).collect()]
        assert sorted(r.term for r in FT.vocabulary_topk(stats, k).collect()) == sorted(want), k


def test_reloaded_models_keep_preparation_and_share_features(spark, split):
    _, train, test = split
    models = M.fit_models(train, FT.WHITESPACE, ("lr", "nb"))
    paths = {n: save_model(m, scratch_path(spark, "test-models", n)) for n, m in models.items()}
    loaded = {n: load_model(p) for n, p in paths.items()}
    assert all(m.profile == FT.WHITESPACE for m in loaded.values())
    both = M.score_all(test, loaded).select("doc_id", "prediction_lr", "prediction_nb")
    alone = M.score_texts(test, models["nb"]).select("doc_id", "prediction")
    assert {(r.doc_id, r.prediction_nb) for r in both.collect()} == {tuple(r) for r in alone.collect()}


def test_a_saved_model_takes_raw_texts_without_this_library(spark, split):
    from pyspark.ml import PipelineModel
    _, train, test = split
    raw = spark.createDataFrame([(1, "2good and 2nice", "x"), (2, None, "y"), (3, "", "z")], "doc_id long, text string, kept string")
    for profile in (FT.ENGLISH, FT.WHITESPACE):
        model = M.fit_models(train, profile, ("nb",))["nb"]
        path = scratch_path(spark, "test-models", "own")
        model.write().save(path)  # MLlib's own writer and reader
        loaded = PipelineModel.load(path)
        a = {tuple(r) for r in loaded.transform(test).select("doc_id", "prediction").collect()}
        b = {tuple(r) for r in M.score_texts(test, model).select("doc_id", "prediction").collect()}
        assert a == b and len(a) == test.count()
        out = loaded.transform(raw)
        assert {r.doc_id: r.words for r in out.collect()} == (
            {1: ["good", "and", "nice"], 3: []} if profile is FT.ENGLISH else {1: ["eciN2".lower(), "dna", "doog2"], 3: []})
        assert "kept" in out.columns


def test_older_models_are_prepared_by_profile(spark, split):
    from pyspark.ml import PipelineModel
    _, train, test = split
    model = M.fit_models(train, FT.ENGLISH, ("nb",))["nb"]
    older = FT.with_profile(PipelineModel(stages=[model.stages[0].stages[1], *model.stages[1:]]), FT.ENGLISH)
    assert not FT.prepares(older) and FT.prepares(model)
    a = {tuple(r) for r in M.score_texts(test, older).select("doc_id", "prediction").collect()}
    assert a == {tuple(r) for r in M.score_texts(test, model).select("doc_id", "prediction").collect()}


def plain_auc(rows):
    pos, neg = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_area_under_roc_is_exact(spark):
    import random
    rng = random.Random(4)
    for spread in (5, 3000):  # few ties broken, and over 1,000 distinct scores
        rows = [(float(rng.randint(0, spread)) / 7, int(rng.random() < 0.3)) for _ in range(2500)]
        df = spark.createDataFrame([*rows, (None, 1), (3.0, None), (2.0, 5)], "score double, label int")
        want = plain_auc(rows)
        for layout in (1, 3, 16):
            got = M.area_under_roc(df.repartition(layout), "score").first()
            assert got.metric == "areaUnderROC" and math.isclose(got.value, want, rel_tol=1e-12)
    one = spark.createDataFrame([(1.0, 1), (2.0, 1)], "score double, label int")
    assert M.area_under_roc(one, "score").first().value is None
    assert M.area_under_roc(one.limit(0), "score").first().value is None
    hot = spark.createDataFrame([(1.0, i % 2) for i in range(3000)], "score double, label int").repartition(5)
    assert M.area_under_roc(hot, "score").first().value == 0.5


def test_area_under_roc_of_a_model_agrees_with_mllib_without_bins(split, models):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    _, _, test = split
    pred = M.score_texts(test, models["lr"]).cache()
    want = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0).evaluate(pred)
    assert math.isclose(M.evaluate(pred, "areaUnderROC"), want, rel_tol=1e-9)


def test_gradient_vanishes_only_at_the_fit(spark, split, models):
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from chirpflow.operators import certificates as CT
    _, train, _ = split
    rows = CT.lr_stationarity(train, models["lr"]).collect()
    assert len(rows) == len(CT.vocabulary_of(models["lr"])) + 1 and all(r.stationary for r in rows)
    tokens = PipelineModel(stages=models["lr"].stages[:-1]).transform(train)
    early = LogisticRegression(featuresCol=FT.WEIGHTS, labelCol="label", maxIter=2).fit(tokens)
    stopped = PipelineModel(stages=[*models["lr"].stages[:-1], early])
    assert not all(r.stationary for r in CT.lr_stationarity(train, stopped).collect())


def test_gradient_equals_finite_differences(spark):
    from chirpflow.operators import certificates as CT
    rows = [(i, f"{'good fine' if i % 3 else 'bad'} thing{i % 4} common", int(i % 3 != 0 or i == 6)) for i in range(24)]
    train = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = M.fit_models(train, names=("lr",))["lr"]
    g = {r.term: r for r in CT.lr_gradient(train, model).collect()}
    data = model.transform(train).select(FT.WEIGHTS, "label").collect()
    lr, vocab = model.stages[-1], CT.vocabulary_of(model)

    def loss(w, b):
        total = 0.0
        for r in data:
            m = sum(float(x) * w[int(i)] for i, x in zip(r[0].indices, r[0].values)) + b
            total += math.log1p(math.exp(-m if r.label else m))
        return total / len(data)
    w, b, step = list(lr.coefficients.toArray()), lr.intercept, 1e-4
    for i, term in enumerate(vocab):
        up, down = w.copy(), w.copy()
        up[i], down[i] = w[i] + step, w[i] - step
        assert math.isclose(g[term].gradient, (loss(up, b) - loss(down, b)) / (2 * step), abs_tol=1e-6)
    assert math.isclose(g[CT.INTERCEPT].gradient, (loss(w, b + step) - loss(w, b - step)) / (2 * step), abs_tol=1e-6)


def test_root_of_a_tree_is_the_best_split(spark, split):
    from chirpflow.operators import certificates as CT
    _, train, _ = split
    fitted = CT.tree_root(M.fit_models(train, FT.ENGLISH, ("dt",))["dt"])
    best = CT.best_split(train).first()
    assert fitted[0] == best.term and math.isclose(fitted[1], best.threshold, rel_tol=1e-9)
    gains = CT.split_gains(train)
    assert gains.agg(F.max("gain")).first()[0] == pytest.approx(best.gain, abs=1e-9)
    pure = spark.createDataFrame([(1, "a b", 1), (2, "a a c", 1)], "doc_id long, text string, label int")
    assert CT.tree_root(M.fit_models(pure, names=("dt",))["dt"]) is None
