"""Scalar text functions against Python string semantics (FIXTURES.md §3)."""

import pytest

from chirpflow.functions import text as T

CLEAN_CASES = [
    ("RT @bob_1: hi http://t.co/x tail", "hi "),
    ("a http://x\nsecond line", "a \nsecond line"),
    ("a https://x\rsecond", "a "),
    ("a http://x second", "a "),
    ("RT @bob: hey", "hey"),
    ("RT @اف: hey", "hey"),
    ("q RT @a: b RT @c: d", "q b d"),
    ("httpfoo x", ""),
    ("RT @a:x", "RT @a:x"),
    (None, None),
]

SHAPE_CASES = [
    ("a b  c ", 3, 7),
    (" lead", 1, 5),
    ("", 0, 0),
    ("   ", 0, 3),
    ("a b", 2, 3),
    ("a b", 2, 3),
    ("a\u001cb", 2, 3),
    ("a\u0085b", 2, 3),
    ("a\tb\nc", 3, 5),
    ("\U0001F600 x", 2, 3),
    ("é", 1, 2),
]


def _one(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_clean_tweet_matches_python_rules(spark):
    got = _one(spark, [c[0] for c in CLEAN_CASES], T.clean_tweet("text"))
    assert got == [c[1] for c in CLEAN_CASES]


def test_clean_agrees_with_python_re(spark):
    import re
    texts = [c[0] for c in CLEAN_CASES if c[0] is not None]
    expected = [re.sub(r"https?.*", "", re.sub(r"RT\s@\w*:\s", "", t)) for t in texts]
    assert _one(spark, texts, T.clean_tweet("text")) == expected


def test_words_and_length_match_python(spark):
    texts = [c[0] for c in SHAPE_CASES]
    assert _one(spark, texts, T.word_count("text")) == [len(t.split()) for t in texts]
    assert _one(spark, texts, T.char_length("text")) == [len(t) for t in texts]
    assert [c[1] for c in SHAPE_CASES] == [len(t.split()) for t in texts]


def test_whitespace_tokens_equal_str_split(spark):
    texts = ["  a　b c\x1fd  ", "x\x0by\x0cz", "", "one"]
    assert _one(spark, texts, T.whitespace_tokens("text")) == [t.split() for t in texts]


def test_space_tokens_keep_empties(spark):
    assert _one(spark, ["a b  c ", ""], T.space_tokens("text")) == [
        ["a", "b", "", "c", ""], [""]]


def test_remove_digits_is_ascii_only(spark):
    assert _one(spark, ["a12٣۴b"], T.remove_digits("text")) == ["a٣۴b"]


def test_reverse_and_utf8(spark):
    texts = ["abc", "زه تا"]
    assert _one(spark, texts, T.reverse_text("text")) == [t[::-1] for t in texts]
    got = _one(spark, texts, T.to_utf8("text"))
    assert [bytes(b) for b in got] == [t.encode("utf-8") for t in texts]


def test_clock_label_unpadded(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 03:04:05.9' AS ts UNION ALL SELECT NULL")
    assert [r[0] for r in df.select(T.clock_label("ts")).collect()] == ["3:4.5", None]


def test_null_in_null_out(spark):
    row = _one(spark, [None], T.word_count("text"))
    assert row == [None]


@pytest.mark.parametrize("text,expected", [
    ("Hello, World's café 3", ["hello", "world", "s", "caf", "3"]),
    ("", []),
])
def test_regex_tokens(spark, text, expected):
    assert _one(spark, [text], T.regex_tokens("text")) == [expected]


def test_english_tokenizer_stage_matches_column_form(spark):
    from pyspark.ml.feature import RegexTokenizer
    df = spark.createDataFrame([("Hello, World's café 3",), ("",)], "text string")
    tok = RegexTokenizer(inputCol="text", outputCol="w", pattern="\\W")
    a = [r.w for r in tok.transform(df).collect()]
    b = [r[0] for r in df.select(T.regex_tokens("text")).collect()]
    assert a == b
