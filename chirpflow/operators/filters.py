"""Row filters and keyword routing.

The collectors hand a keyword list to a remote service ("track") and publish
each match to one topic per script.  Here the rule is explicit and the five
scripts become one ``(topic, keyword)`` table: a text matches a keyword when all
word tokens of the keyword, lower-cased, are among the text's lower-cased word
tokens, in any order.  A keyword without a word matches nothing.  One text can go
to several topics.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import regex_tokens


def drop_null_text(df: DataFrame, cols: Sequence[str] = ("text",)) -> DataFrame:
    """Drop rows with NULL in ``cols`` (the tokenizer fails on NULL)."""
    return df.na.drop(subset=list(cols))


def keyword_filter(df: DataFrame, keywords: Iterable[str], text_col: str = "text",
                   unicode: bool = False) -> DataFrame:
    """P10: keep rows whose text has all words of any keyword as whole tokens (any case)."""
    kws = sorted({k.lower() for k in keywords})
    if not kws:
        return df.limit(0)
    one_word = [k for k in kws if re.fullmatch("[a-z0-9_]+", k)]
    others = [F.array_distinct(regex_tokens(F.lit(k), unicode)) for k in kws if k not in one_word]

    def matches(tokens: Column) -> Column:
        found = F.arrays_overlap(tokens, F.array(*map(F.lit, one_word))) if one_word else F.lit(False)
        for phrase in others:  # folded to literals by the optimizer
            found |= (F.size(phrase) > 0) & (F.size(F.array_except(phrase, tokens)) == 0)
        return found
    # a one-element array binds the tokens, so that the text is split once
    return df.filter(F.exists(F.array(regex_tokens(text_col, unicode)), matches))


def routes_frame(spark: SparkSession,
                 routes: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """``[(topic, [keywords])]`` to a ``(topic, keyword)`` frame, from an Arrow
    table: no plan expression per keyword, however many there are."""
    topics, keywords = [], []
    for topic, kws in routes:
        topics += [topic] * len(kws)
        keywords += kws
    return spark.createDataFrame(pa.table({"topic": pa.array(topics, pa.string()),
                                           "keyword": pa.array(keywords, pa.string())}))


def keyword_tokens(routes: DataFrame, unicode: bool = False) -> DataFrame:
    """``(topic, phrase, need, _token)``: a row per word of each keyword and topic.
    ``phrase`` is NULL for a keyword of one word."""
    words = F.array_distinct(regex_tokens("keyword", unicode))
    keys = (routes.filter(F.col("keyword").isNotNull() & F.col("topic").isNotNull())
            .select("topic", F.array_sort(words).alias("_words")).distinct()
            .select("topic", F.when(F.size("_words") > 1, F.array_join("_words", " ")).alias("phrase"),
                    F.size("_words").alias("need"), F.explode_outer("_words").alias("_token")))
    return keys.filter(F.col("_token").isNotNull())


def _matched(tokens: DataFrame, words: DataFrame, *carried: str) -> DataFrame:
    """``(_row, *carried, _topics)`` from rows with a distinct ``_token`` each.

    Only matches are exchanged, one-word keywords once per topic, and matches of a
    text that many rows share are combined before.  A keyword of several words
    needs as many different matched tokens as it has words (relational division):
    in a row's sorted matches its entries follow each other, so the entry
    ``need - 1`` places after its first is still its own."""
    hit = F.struct("topic", "phrase", "need", F.when(F.col("need") > 1, F.col("_token")).alias("token"))
    by_row = tokens.join(words, "_token").groupBy("_row").agg(
        *[F.first(c).alias(c) for c in carried], F.array_sort(F.collect_set(hit)).alias("_hits"))

    def whole(x: Column, i: Column) -> Column:
        last = F.try_element_at("_hits", i + x["need"])
        return (x["need"] == 1) | ((last["topic"] == x["topic"]) & (last["phrase"] == x["phrase"]))
    topics = F.array_distinct(F.transform(F.filter("_hits", whole), lambda x: x["topic"]))
    return by_row.select("_row", *carried, topics.alias("_topics"))


def _tokens_of(rows: DataFrame, tokens: Column, *carried: str) -> DataFrame:
    """One row per distinct token.  ``explode_outer`` and a filter, since for
    ``explode`` Catalyst would evaluate the tokenizer a second time."""
    return (rows.select("_row", *carried, F.explode_outer(F.array_distinct(tokens)).alias("_token"))
            .filter(F.col("_token").isNotNull()))


def text_key(text_col: str) -> Column:
    """A stable identity of a text: 16 bytes of its SHA-256.  Rows of equal text
    have equal matches, so they may share it."""
    return F.substring(F.unhex(F.sha2(F.col(text_col).cast("binary"), 256)), 1, 16)


def keyword_route(df: DataFrame, routes: DataFrame, id_col: str | None = "doc_id",
                  text_col: str = "text", keep: Sequence[str] = (),
                  unicode: bool = False) -> DataFrame:
    """One row per input row and matching topic: ``id_col, topic, *keep``.

    What is exploded and exchanged per token is a row key, the token and at most
    ``id_col``, never a text or a kept column.  Where columns are kept, the key is
    the text's digest, and the matches, one row per text, are joined with the rows;
    else it is a row number.  Equal or NULL ids stay separate rows, and ``id_col``
    may be None.  Spark broadcasts the keywords, or the matches, if their measured
    size is under the threshold; else they are shuffled, and a hot token or text is
    split by AQE's skew join.  NULL keywords match nothing and NULL topics route
    nothing.

    The grouping needs whole batches: on a stream use it in ``foreachBatch``
    (``run_to_table(transform=...)``, ``collect_to_kafka``).
    """
    if df.isStreaming:
        raise ValueError("route a stream per micro-batch: pass the routing as the batch transform")
    words = keyword_tokens(routes, unicode)
    others = [c for c in dict.fromkeys(keep) if c != id_col]
    if not others:
        own = df.select(F.monotonically_increasing_id().alias("_row"), F.col(text_col).alias("_text"),
                        *([F.col(id_col).alias("_id")] if id_col else []))
        carried = ["_id"] if id_col else []
        found = _matched(_tokens_of(own, regex_tokens("_text", unicode), *carried), words, *carried)
        return found.select(*([F.col("_id").alias(id_col)] if id_col else []), F.explode("_topics").alias("topic"))
    texts = df.select(text_key(text_col).alias("_row"), F.col(text_col).alias("_text"))
    found = _matched(_tokens_of(texts, regex_tokens("_text", unicode)), words)
    rows = df.select(text_key(text_col).alias("_row"), F.struct(*([id_col] if id_col else []), *others).alias("_kept"))
    routed = rows.join(found, "_row").select("_kept", F.explode("_topics").alias("topic"))
    return routed.select(*([f"_kept.{id_col}"] if id_col else []), "topic", *(f"_kept.{c}" for c in others))
