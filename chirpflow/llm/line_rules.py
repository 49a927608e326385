"""Quality rules, line first.

Each line is judged by itself: punctuation, navigation, boilerplate and
repetition.  Lines that fail are removed, and a document that loses more than
``max_loss`` percent of its word characters is rejected, as is one that fails
the document rules (too few words, too many words in repeated windows).

Edge cases: a NULL or empty text has no words, so it is rejected with zero
counts; a text without a line break is one line; lines without a word are
neither judged nor counted; repeated rows and equal ids are judged row by row;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common as C

# Fixed values.  White space is x09-x0D and x20; symbols are the contract's.
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
#: A line that ends like this is a sentence, an item or a heading with a colon.
ENDING = re.compile(rb"(?:[.!?:;,)\]\"'|-]|\xe2\x80\xa6|\xe2\x80\x9d|\xc2\xbb|\xe3\x80\x82)$")
#: Menu separators.
SEPARATORS = re.compile(rb"[|>]|\xc2\xbb|\xe2\x80\xa2|\xc2\xb7")
#: Phrases of site furniture; they count in lines of at most BOILERPLATE_WORDS words.
PHRASES = (b"all rights reserved", b"privacy policy", b"cookie policy", b"use cookies", b"terms of use",
           b"terms of service", b"enable javascript", b"sign in", b"log in", b"subscribe to our", b"click here",
           b"skip to content", b"read more", b"share this")
BOILERPLATE = re.compile(b"|".join(map(re.escape, PHRASES)))
BOILERPLATE_WORDS = 30
SHORT_LINE_WORDS = 4
MIN_WORDS, MAX_REPEATED, MAX_LOSS = 50, 50, 50

FIELDS = {"doc_id": "long", "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
          "n_repeat_words": "long", "base_failed": "boolean", "kept": "boolean", "n_lines": "long",
          "n_removed_lines": "long", "removed_chars": "long", "removed_rules": "string"}
SCHEMA = ", ".join(f"{k} {v}" for k, v in FIELDS.items())
ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice."""
    n = len(words) - 2
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter([known.setdefault(w, len(known)) for w in words], np.int64, len(words))
    if len(known) == len(words):
        return 0
    v = len(known)
    if v < 2_000_000:
        codes = (ids[:-2] * v + ids[1:-1]) * v + ids[2:]
    else:  # three ids no longer fit in 63 bits: number the pairs first
        pairs = np.unique(ids[:-1] * v + ids[1:], return_inverse=True)[1]
        codes = pairs[:-1] * v + ids[2:]
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    inside = np.zeros(n + 2, bool)
    for shift in range(3):
        inside[shift:shift + n] |= again
    return int(inside.sum())


def word_chars(data: bytes) -> int:
    """Code points outside white space."""
    return len(data.translate(None, SPACE + CONTINUATION))


def line_rule(line: bytes, n_words: int, seen: set[bytes]) -> str:
    """The name of the first rule the line fails, or ``""``."""
    if line in seen:
        return "repeated"
    separators = len(SEPARATORS.findall(line))
    if separators >= 2 and 2 * separators >= n_words - sum(SEPARATORS.fullmatch(w) is not None for w in line.split()):
        return "navigation"
    if n_words <= BOILERPLATE_WORDS and BOILERPLATE.search(line.lower()):
        return "boilerplate"
    if len(line) - len(line.translate(None, SYMBOLS)) > n_words:
        return "punctuation"
    if n_words < SHORT_LINE_WORDS and not ENDING.search(line.rstrip(SPACE)):
        return "punctuation"
    return ""


def clean_lines(data: bytes) -> tuple[list[bytes], dict]:
    """The lines that stay, and the counts."""
    seen: set[bytes] = set()
    kept, rules, lost, judged, dups = [], [], 0, 0, 0
    for line in data.split(b"\n"):
        n = len(line.split())
        if not n:
            kept.append(line)
            continue
        judged += 1
        dups += line in seen
        rule = line_rule(line, n, seen)
        seen.add(line)
        if rule:
            rules.append(rule)
            lost += word_chars(line)
        else:
            kept.append(line)
    return kept, {"n_lines": judged, "n_dup_lines": dups, "n_removed_lines": len(rules), "removed_chars": lost,
                  "removed_rules": ",".join(sorted(set(rules)))}


def judge(data: bytes | None) -> dict:
    """All columns of one document but its id."""
    data = data or b""
    words = data.split()
    _, row = clean_lines(data)
    chars, repeated = word_chars(data), repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEATED * len(words)
    return row | {"n_words": len(words), "word_chars": chars, "n_repeat_words": repeated,
                  "n_symbols": len(data) - len(data.translate(None, SYMBOLS)), "base_failed": failed,
                  "kept": not failed and 100 * row["removed_chars"] <= MAX_LOSS * chars}


def judge_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = [judge(t) for t in batch.column("text").to_pylist()]
    arrays = [pa.array([r[k] for r in rows], ARROW[v]) for k, v in FIELDS.items() if k != "doc_id"]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=list(FIELDS))


def line_first_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, the two verdicts and what was removed.
    A narrow map over the scan; nothing is shuffled."""
    return C.texts(docs, id_col, text_col).mapInArrow(C.per_batch(judge_batch), SCHEMA)


def cleaned_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, kept)``: the text without its failed lines."""
    def clean(batch):
        rows = batch.column("text").to_pylist()
        out = [None if t is None else b"\n".join(clean_lines(t)[0]).decode() for t in rows]
        kept = [judge(t)["kept"] for t in rows]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string()), pa.array(kept)],
                                          names=["doc_id", "text", "kept"])
    return C.texts(docs, id_col, text_col).mapInArrow(C.per_batch(clean), "doc_id long, text string, kept boolean")
