"""Property tests: the column functions agree with Python's string rules on
generated text (one Spark job per generated batch)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chirpflow.functions import text as T

# Characters that exercise the rules: marker and URL pieces, Python whitespace
# (including U+001C..U+001F, U+0085, U+00A0, U+2028), ASCII and non-ASCII
# digits and letters, a No-category digit, a combining mark and an emoji.
ALPHABET = list("RT@:_ htps/.xaZ09") + [
    "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", " ", " ",
    "　", "é", "ا", "中", "٣", "²", "́", "\U0001F600", "-", ",",
]
FRAGMENTS = ["RT @", "RT @bob: ", "RT\xa0@x_1: ", "http://t.co/x ", "https", ": "]

text = st.lists(st.one_of(st.sampled_from(ALPHABET), st.sampled_from(FRAGMENTS)),
                max_size=30).map("".join)
batches = st.lists(text, min_size=40, max_size=40)
SETTINGS = settings(max_examples=4, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])


def _eval(spark, values, exprs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    return df.orderBy("i").select(*exprs).collect()


@SETTINGS
@given(batches)
def test_cleaning_equals_python_re(spark, values):
    rows = _eval(spark, values, [T.strip_retweet("text"), T.clean_tweet("text"),
                                 T.remove_digits("text")])
    for v, (no_rt, clean, no_digits) in zip(values, rows):
        py_no_rt = re.sub(r"RT\s@\w*:\s", "", v)
        assert no_rt == py_no_rt, v
        assert clean == re.sub(r"https?.*", "", py_no_rt), v
        assert no_digits == re.sub(r"\d+", "", v, flags=re.ASCII), v


@SETTINGS
@given(batches)
def test_shape_and_tokens_equal_python(spark, values):
    rows = _eval(spark, values, [T.word_count("text"), T.char_length("text"),
                                 T.whitespace_tokens("text"), T.space_tokens("text"),
                                 T.reverse_text("text")])
    for v, (words, length, ws, sp, rev) in zip(values, rows):
        assert words == len(v.split()), v
        assert length == len(v), v
        assert ws == v.split(), v
        assert sp == v.split(" "), v
        assert rev == v[::-1], v


@SETTINGS
@given(batches)
def test_url_and_digit_cleaning_idempotent(spark, values):
    once = [r[0] for r in _eval(spark, values, [T.strip_urls(T.remove_digits("text"))])]
    twice = [r[0] for r in _eval(spark, once, [T.strip_urls(T.remove_digits("text"))])]
    assert once == twice


TOKEN_ALPHABET = list("aZ09_ -,.'") + ["K", "İ", "Σ", "é", "ß", "\n", "\xa0", "٣"]
token_text = st.lists(st.sampled_from(TOKEN_ALPHABET), max_size=25).map("".join)


@SETTINGS
@given(st.lists(token_text, min_size=40, max_size=40))
def test_english_tokens_equal_python(spark, values):
    from chirpflow.operators import features as FT
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    rows = FT.tokenize(df, FT.ENGLISH).orderBy("i").select("words").collect()
    for v, r in zip(values, rows):
        digitless = re.sub(r"\d+", "", v, flags=re.ASCII)
        expected = [t for t in re.split(r"\W", digitless.lower(), flags=re.ASCII) if t]
        assert r.words == expected, v
