"""Scalar text functions (F1-F12): ``Column -> Column``.

All are built-in Catalyst expressions, so they run inside whole-stage codegen
and work unchanged on batch and streaming DataFrames.  Python string semantics
(``re`` / ``str.split`` / ``len``) are the contract; the patterns in
``constants`` carry the flags that make Java regex agree with them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_retweet(c: Column | str) -> Column:
    """remove every "RT @handle: " marker anywhere in the text."""
    return F.regexp_replace(_col(c), C.RETWEET_MARKER, "")


def strip_urls(c: Column | str, mode: str = "line") -> Column:
    """``mode="line"`` drops from the first http(s) to the end of that line
    (the collectors' rule); ``mode="token"`` drops only the URL token."""
    if mode == "line":
        pattern = C.URL_TO_EOL
    elif mode == "token":
        pattern = C.URL_TOKEN
    else:
        raise ValueError(f"unknown URL mode {mode!r}")
    return F.regexp_replace(_col(c), pattern, "")


def clean_tweet(c: Column | str, url_mode: str = "line") -> Column:
    """retweet marker first, then URLs; no trimming."""
    return strip_urls(strip_retweet(c), url_mode)


def remove_digits(c: Column | str) -> Column:
    """drop ASCII digit runs."""
    return F.regexp_replace(_col(c), C.DIGITS, "")


def reverse_text(c: Column | str) -> Column:
    """reverse by code point."""
    return F.reverse(_col(c))


def space_tokens(c: Column | str) -> Column:
    """split on one space; keeps empty tokens ("" -> [""])."""
    return F.split(_col(c), " ")


def whitespace_tokens(c: Column | str) -> Column:
    """split on whitespace runs, no empty tokens (Python ``str.split()``).
    ``array_remove`` (not a lambda ``filter``) keeps it inside whole-stage codegen."""
    return F.array_remove(F.split(_col(c), C.PY_WHITESPACE_RUN), "")


def word_count(c: Column | str) -> Column:
    """F8: number of whitespace-separated words, BIGINT."""
    return F.size(whitespace_tokens(c)).cast("bigint")


def char_length(c: Column | str) -> Column:
    """length in code points, BIGINT."""
    return F.char_length(_col(c)).cast("bigint")


def to_utf8(c: Column | str) -> Column:
    """string to UTF-8 bytes."""
    return F.encode(_col(c), "UTF-8")


def clock_label(ts: Column | str) -> Column:
    """unpadded ``H:M.S`` label of a timestamp (NULL for NULL)."""
    t = _col(ts)
    return F.concat(F.hour(t).cast("string"), F.lit(":"), F.minute(t).cast("string"), F.lit("."),
                    F.second(t).cast("string"))


def literal(value) -> Column:
    """F12."""
    return F.lit(value)


def regex_tokens(c: Column | str, unicode: bool = False) -> Column:
    """Lower-case and split on non-word characters, dropping empty tokens.

    The column form of the English tokenizer; used for keyword matching so a
    stream needs no ML stage.
    """
    sep = C.NON_WORD_UNICODE if unicode else C.NON_WORD
    return F.array_remove(F.split(F.lower(_col(c)), sep), "")


def shape(c: Column | str = "text") -> list[Column]:
    """One text to ``(text, words, length)``."""
    t = _col(c)
    return [t.alias("text"), word_count(t).alias("words"), char_length(t).alias("length")]
