"""Keyword filter and routing."""

import pytest

from chirpflow.operators import filters as FL
from chirpflow.plans.queries import DEMO_ROUTES

ROUTES = DEMO_ROUTES[:4]


def _docs(spark):
    rows = [(1, "The Taliban and Afghanistan"), (2, "#TalibanOurGaurdians today"),
            (3, "nothing here"), (4, "afghanrefugees welcome, afghan news"), (5, None)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_keyword_filter_whole_tokens_any_case(spark):
    got = FL.keyword_filter(_docs(spark), ["AFGHAN", "taliban"]).select("doc_id")
    assert sorted(r[0] for r in got.collect()) == [1, 4]


def test_route_multi_topic_and_hashtag(spark):
    routes = FL.routes_frame(spark, ROUTES)
    got = {tuple(r) for r in FL.keyword_route(_docs(spark), routes).collect()}
    assert got == {
        (1, "afghan_tweets"), (1, "taliban_tweets"), (1, "afghan_afghanistan_tweets"),
        (2, "afghan_tweets"), (2, "taliban_tweets"),
        (4, "afghan_tweets"), (4, "afghan_afghanistan_tweets"), (4, "afghan_refugee_tweets"),
    }


def test_route_counts_rows_not_ids(spark):
    rows = [(1, "taliban one"), (1, "taliban two"), (None, "taliban three"), (None, "taliban three"), (2, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    routes = FL.routes_frame(spark, [("t", ["taliban", "Taliban", None]), (None, ["taliban"])])
    for setting in (spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), "-1"):
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", setting)
        try:
            got = FL.keyword_route(docs, routes, keep=["text"]).collect()
            alone = FL.keyword_route(docs.select("text"), routes, id_col=None, keep=["text"]).collect()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        want = sorted([(str(i), "t", t) for i, t in rows if t != "none"])
        assert sorted((str(r.doc_id), r.topic, r.text) for r in got) == want
        assert sorted((r.topic, r.text) for r in alone) == sorted(w[1:] for w in want)


def test_route_with_more_keywords_than_fit_a_plan(spark):
    routes = spark.range(20_000).selectExpr("concat('t', id % 7) AS topic", "concat('word', id) AS keyword")
    docs = spark.createDataFrame([(1, "word3 and word10 word19999"), (2, "word20000")], "doc_id long, text string")
    got = {tuple(r) for r in FL.keyword_route(docs, routes).collect()}
    assert got == {(1, "t3"), (1, f"t{19999 % 7}")}


def test_keywords_of_several_words(spark):
    docs = spark.createDataFrame([(1, "from New York to York"), (2, "York, a new one"), (3, "New Jersey"), (4, None),
                                  (5, "york york york")], "doc_id long, text string")
    routes = FL.routes_frame(spark, [("city", ["New York"]), ("york", ["York York", "!!!", ""]), ("both", ["jersey NEW", "one"])])
    want = {(1, "city"), (2, "city"), (1, "york"), (2, "york"), (5, "york"), (2, "both"), (3, "both")}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for setting in (old, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", setting)
        try:
            got = [tuple(r) for r in FL.keyword_route(docs, routes).collect()]
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        assert set(got) == want and len(got) == len(want)
    for keywords, ids in ((["New York"], {1, 2}), (["york jersey", "jersey"], {3}), (["!!!", ""], set()), (["new-one", "x"], {2})):
        assert {r.doc_id for r in FL.keyword_filter(docs, keywords).collect()} == ids, keywords


def test_one_word_of_each_phrase_is_no_match(spark):
    """Words of different phrases, or of copies of a row, must not add up."""
    docs = spark.createDataFrame([(i, "red green") for i in range(6)] + [(9, "red blue")], "doc_id long, text string")
    routes = FL.routes_frame(spark, [("t", ["red yellow", "green black"]), ("u", ["blue red", "red green white"])])
    assert {tuple(r) for r in FL.keyword_route(docs.repartition(3), routes).collect()} == {(9, "u")}


def test_many_keywords_are_planned_fast(spark):
    import time
    start = time.perf_counter()
    routes = FL.routes_frame(spark, [("t", [f"word{i}" for i in range(100_000)])])
    plan = routes._jdf.queryExecution().optimizedPlan().toString()
    assert time.perf_counter() - start < 10 and len(plan) < 10_000
    docs = spark.createDataFrame([(1, "word99999"), (2, "word100000")], "doc_id long, text string")
    assert [r.doc_id for r in FL.keyword_route(docs, routes).collect()] == [1]


def test_route_other_scripts(spark):
    docs = spark.createDataFrame([(1, "زه طالبان نه"), (2, "un été"), (3, "x")], "doc_id long, text string")
    routes = FL.routes_frame(spark, [("a", ["طالبان"]), ("b", ["été"])])
    assert {tuple(r) for r in FL.keyword_route(docs, routes, unicode=True).collect()} == {(1, "a"), (2, "b")}


def test_route_refuses_a_stream(spark):
    stream = spark.readStream.format("rate").load().selectExpr("value AS doc_id", "'taliban' AS text")
    with pytest.raises(ValueError):
        FL.keyword_route(stream, FL.routes_frame(spark, ROUTES))


def test_drop_null_text(spark):
    assert FL.drop_null_text(_docs(spark)).count() == 4
