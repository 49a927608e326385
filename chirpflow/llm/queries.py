"""Registered queries of the operators, with production parameters on whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import common as C
from . import (
    bpe, chat, ctw, hnsw, importance, langid, line_rules, ngram_join, packing, pii_crf, quality, repair, warc,
)
from .oracle import ORACLE  # noqa: F401 - part of the registration


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packing (1): pieces of all documents in windows of 2048 tokens."""
    return packing.pack(C.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                        with_ids=False)


def op2_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate nearest neighbours (2): small-world graphs per shard."""
    return hnsw.nearest(C.table(spark, sf_dir, "embeddings"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality classifier (3): boosted trees on document statistics."""
    docs = C.table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit(docs, C.table(spark, sf_dir, "labels")))


def op4_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores (4): context-tree weighting over bytes."""
    return ctw.score_texts(C.table(spark, sf_dir, "documents"))


def op5_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data (5): rules plus a skip-chain conditional random field."""
    return pii_crf.personal_data(C.table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (6): near-duplicate components of all documents."""
    return ngram_join.near_duplicates(C.table(spark, sf_dir, "documents")).drop("row")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE (7): recursive queries encode, ordered aggregation decodes."""
    return bpe.digests(C.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                       public_tokenizers.PATTERN)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC (8): Zstandard archives of all pages, written and read back."""
    pages = C.table(spark, sf_dir, "pages")
    return warc.records(warc.write(pages), payloads=False).drop("url")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language ID (9): Kneser-Ney character models."""
    return langid.identify(C.table(spark, sf_dir, "documents"))


def op10_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules (10), line first."""
    return line_rules.line_first_rules(C.table(spark, sf_dir, "documents"))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance resampling (11) of all documents towards the benchmark texts."""
    return importance.resample(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat formatting (12): all conversations written with their loss mask and read back."""
    rows = chat.with_injection(spark, C.table(spark, sf_dir, "conversations"))
    return chat.digests(C.write_once(chat.format_chats(rows), "chats"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation repair (13): the cheapest edits of all damaged conversations."""
    return repair.repair(C.table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_pack, op2_hnsw, op3_quality, op4_ctw, op5_pii_crf, op6_ngram_join, op7_bpe, op8_warc, op9_language, op10_line_rules,
    op11_resample, op12_chat, op13_repair)}
