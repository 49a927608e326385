"""Corpus preparation: quality, language, near duplicates, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All stages but
the last return the columns of ``documents``.

Edge cases, for every stage: an empty table gives an empty result with the same
columns; repeated rows and equal or NULL ids are judged row by row; texts are read
whole, however long; other columns pass unread, whatever their names.  What a NULL
or empty text comes to is said at each stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpflow.llm import common as C
from chirpflow.llm import langid, ngram_join, packing, pii_crf, quality


#: Bytes of rows that Spark sends a Python worker at once.  Its own default sends 10,000 rows,
#: whatever their length, and the executor holds such a batch on both sides.
BATCH_BYTES = 4 << 20
#: Word spellings that a packing worker keeps: the workers' memory is shared with four stages before.
CACHED_WORDS = 100_000


def bounded(docs: DataFrame) -> DataFrame:
    """``docs``, with batches to Python workers bounded by bytes as well as by rows."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (3).  A NULL or empty text is
    scored by its statistics, which are all zero; without labelled rows the
    classifier is a constant."""
    return quality.kept(bounded(docs), quality.fit(docs, C.table(spark, sf_dir, "labels")))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification does not reject (9).  A NULL text or
    one without a letter has no language and goes."""
    return langid.kept(bounded(docs), train=docs.filter(C.fold(F.col("doc_id")) != 0))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (6): the least id, of equal
    ids one row.  Texts without a word link with nothing, so each of them stays."""
    return ngram_join.one_of_each(bounded(docs))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data masked in every text (5); ``n_chars`` follows the text.  NULL
    stays NULL, and every row stays."""
    out = pii_crf.masked(bounded(docs))
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else out


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their token ids (1).  A NULL or empty text
    is the end id alone."""
    return packing.pack(bounded(docs), public_tokenizers.path("word_bpe_49k.json"), cached_words=CACHED_WORDS)


STAGES = [("quality", quality_stage), ("language", language_stage), ("near_duplicates", near_duplicate_stage),
          ("personal_data", personal_data_stage), ("packing", packing_stage)]

#: SQL cannot express the learned stages or the join; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  When a stage's result has been written, the
    copies it made and the result before it are deleted; what the last stage reads
    stays as long as its result may be computed."""
    docs, before = C.table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        older = C.written()
        result = C.write_once(stage(spark, docs, sf_dir), f"pipeline_{name}")
        *copies, own = [p for p in C.written() if p not in older]
        C.free(spark, copies + before)
        docs, before = result, [own]
    return STAGES[-1][1](spark, docs, sf_dir)
