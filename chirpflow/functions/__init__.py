"""Column -> Column text functions."""

from .text import (  # noqa: F401
    char_length, clean_tweet, clock_label, literal, regex_tokens,
    remove_digits, reverse_text, shape, space_tokens, strip_retweet, strip_urls,
    to_utf8, whitespace_tokens, word_count,
)
