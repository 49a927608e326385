"""Target-distribution importance resampling with CRC buckets of word n-grams.

A document is lower-cased and its words are joined by single spaces.  One scan of
these bytes stores the running CRC-32 at every word's start and end.  The CRC of
any run of words then follows from two of the stored values: the register is
linear over GF(2), so carrying the first value on over the run's length (a table
look-up per byte of the register) and adding it to the second cancels everything
before the run.  No n-gram is ever built as a string.

The corpus and the target are each one histogram of ``BUCKETS`` numbers.  Their
log ratio per bucket, averaged over a document's features, is its weight; with a
Gumbel variate from a hash of the id, the highest scores are a draw without
replacement.

Edge cases: a NULL or empty text, or one without a word, has no features and
weight 0; a NULL id hashes as ``7:`` and is last among equal scores; equal rows
are scored and drawn one by one; an empty table gives an empty result, and an
empty target one where every ``t`` is 0; a text of any length is scanned in
pieces; bytes that are not UTF-8 count as word bytes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.prepare import with_position
from . import common as C

BUCKETS, NGRAMS, SEED, MIN_WORDS, PERCENT = 10_000, 2, 7, 20, 25
#: Bytes of text scanned at once; a longer text is scanned piece by piece.
PIECE = 1 << 20

# ------------------------------------------------------------------- CRC-32

#: Fixed value: the reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
FULL = np.uint32(0xFFFFFFFF)
#: Bytes per row of the scan, and lengths with a table of their own.
ROW, LENGTHS = 64, 256


def _byte_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), c >> np.uint32(1))
    return c.astype(np.uint32)


TABLE = _byte_table()


def _apply(operator: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A linear map of registers, given by its value for each byte at each place."""
    return (operator[0][c & np.uint32(255)] ^ operator[1][(c >> np.uint32(8)) & np.uint32(255)]
            ^ operator[2][(c >> np.uint32(16)) & np.uint32(255)] ^ operator[3][c >> np.uint32(24)])


def _tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """The maps that carry a register over 0 to ``LENGTHS`` - 1 zero bytes, and
    over ``LENGTHS`` times each power of two."""
    one = np.arange(256, dtype=np.uint32)
    own = [np.stack([one << np.uint32(8 * k) for k in range(4)])]
    for _ in range(LENGTHS):
        own.append(TABLE[own[-1] & np.uint32(255)] ^ (own[-1] >> np.uint32(8)))
    powers = [own.pop()]
    for _ in range(32):
        powers.append(_apply(powers[-1], powers[-1]))
    return np.stack(own), powers


CARRY, POWERS = _tables()


def carried(c: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Registers ``c`` carried over ``length`` zero bytes each."""
    r = length & (LENGTHS - 1)
    b = np.uint32(255)
    out = (CARRY[r, 0, c & b] ^ CARRY[r, 1, (c >> np.uint32(8)) & b]
           ^ CARRY[r, 2, (c >> np.uint32(16)) & b] ^ CARRY[r, 3, c >> np.uint32(24)])
    rest, k = length // LENGTHS, 0
    while rest.any():
        odd = np.flatnonzero(rest & 1)
        out[odd] = _apply(POWERS[k], out[odd])
        rest, k = rest >> 1, k + 1
    return out


def running_crc(data: np.ndarray) -> np.ndarray:
    """The register (from 0, without the final complement) before each byte of
    ``data`` and after the last.  Rows of ``ROW`` bytes are scanned side by side;
    the registers at their ends are then combined by doubling."""
    n = len(data)
    rows = -(-n // ROW) or 1
    padded = np.zeros(rows * ROW, np.uint8)
    padded[:n] = data
    columns = np.ascontiguousarray(padded.reshape(rows, ROW).T)
    inside = np.zeros((ROW + 1, rows), np.uint32)
    for i in range(ROW):
        inside[i + 1] = TABLE[(inside[i] ^ columns[i]) & np.uint32(255)] ^ (inside[i] >> np.uint32(8))
    ends, step = inside[ROW].copy(), 1
    while step < rows:  # ends[i] covers the rows from 0 to i once step reaches their number
        ends[step:] ^= carried(ends[:-step], np.full(rows - step, step * ROW))
        step *= 2
    starts = np.r_[np.zeros(1, np.uint32), ends[:-1]]
    out = np.empty((rows, ROW), np.uint32)
    for i in range(ROW):
        out[:, i] = inside[i] ^ _apply(CARRY[i], starts)
    return np.r_[out.ravel()[:n], (out.ravel()[n:n + 1] if n < rows * ROW else ends[-1:])]


# ----------------------------------------------------------------- features

def _lowered() -> np.ndarray:
    """Each byte as it counts in a word, 0 for a separator."""
    out = np.arange(256, dtype=np.uint8)
    out[0x41:0x5B] += 0x20
    word = np.zeros(256, bool)
    word[0x30:0x3A] = word[0x61:0x7B] = word[0x80:] = True
    return np.where(word[out], out, 0).astype(np.uint8)


LOWERED = _lowered()


class Features:
    """Buckets of all word n-grams of some texts: ``bucket`` and ``text`` (its
    index) per feature, and ``words`` per text.  ``overlap`` tells for each text
    how many of its first words only give context: features that lie in them
    alone belong to the text before."""

    def __init__(self, texts: list[bytes], overlap: list[int] | None = None, ngrams: int = NGRAMS,
                 buckets: int = BUCKETS):
        n = len(texts)
        raw = LOWERED[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
        word = raw != 0
        ends_a_word = np.r_[False, word[:-1] & ~word[1:]]  # the separator after a word stays, all others go
        keep = word | ends_a_word
        data = np.where(word, raw, np.uint8(0x20))[keep]
        ends = np.flatnonzero(data == 0x20)
        starts = np.r_[0, ends[:-1] + 1][:len(ends)]
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        owner = np.searchsorted(text_ends, np.flatnonzero(ends_a_word) - 1, "right")
        self.words = np.bincount(owner, minlength=n)
        crc = running_crc(data)
        first = np.cumsum(self.words) - self.words
        context = np.asarray(overlap if overlap is not None else np.zeros(n, int))
        place = np.arange(len(ends)) - first[owner]
        self.bucket, self.text = [], []
        for k in range(ngrams):
            i = np.arange(max(0, len(ends) - k))
            i = i[(owner[i] == owner[i + k]) & (place[i] + k >= context[owner[i]])]
            length = ends[i + k] - starts[i]
            value = crc[ends[i + k]] ^ carried(crc[starts[i]] ^ FULL, length) ^ FULL
            self.bucket.append((value % np.uint32(buckets)).astype(np.int64))
            self.text.append(owner[i])
        self.bucket, self.text = np.concatenate(self.bucket), np.concatenate(self.text)
        self.words = np.maximum(0, self.words - context)


def pieces(text: bytes, size: int = PIECE) -> list[tuple[bytes, int]]:
    """A text in pieces of about ``size`` bytes, cut at separators, each with the
    number of words that it repeats from the piece before."""
    if len(text) <= size:
        return [(text, 0)]
    word = LOWERED[np.frombuffer(text, np.uint8)] != 0
    starts = np.flatnonzero(word & ~np.r_[False, word[:-1]])
    ends = np.flatnonzero(word & ~np.r_[word[1:], False]) + 1
    out, i = [], 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + size, "right")))
        back = min(i, NGRAMS - 1)
        out.append((text[starts[i - back]:ends[j - 1]], back))
        i = j
    return out or [(b"", 0)]


def batch_features(texts: list[bytes | None], piece: int = PIECE):
    """Yields ``(first, Features)`` for runs of whole texts and for each piece of a long one."""
    run, first, size = [], 0, 0
    for i, text in enumerate(texts):
        text = text or b""
        if run and size + len(text) > piece:
            yield np.arange(first, first + len(run)), Features(run)
            run, first, size = [], i, 0
        if len(text) > piece:
            for part, back in pieces(text, piece):
                yield np.array([i]), Features([part], [back])
            first = i + 1
            continue
        run.append(text)
        size += len(text)
    if run:
        yield np.arange(first, first + len(run)), Features(run)


# ---------------------------------------------------------------- operators

def histogram(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)``: the features of all texts per bucket.  Each task sends one
    row per bucket it has seen, so the shuffle has at most ``buckets`` rows a task."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in C.small_batches(batches, 2 * PIECE):
            for _, f in batch_features(batch.column("text").to_pylist()):
                total += np.bincount(f.bucket, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])
    return (docs.select(F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
            .mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the log ratio of target to source per bucket.  The two
    histograms, at most ``buckets`` rows each, are all that reaches the driver."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for into, frame in ((s, source), (t, target)):
        for row in frame.collect():
            into[row["bucket"]] = row["n"]
    total_s, total_t = int(s.sum()), int(t.sum())
    return np.array([math.floor(1000 * math.log((float(b + 1) * float(total_s + buckets))
                                                / (float(a + 1) * float(total_t + buckets))))
                     for a, b in zip(s.tolist(), t.tolist())], np.int64)


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    """Thousandths of the Gumbel variate that belongs to an id."""
    own = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(own.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


def scored(docs: DataFrame, gain: np.ndarray, seed: int = SEED, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per document (``SCORED``); a narrow map over the scan."""
    def run(batches):
        for batch in C.small_batches(batches, 2 * PIECE):
            ids = batch.column("doc_id").to_pylist()
            words, n, total = (np.zeros(len(ids), np.int64) for _ in range(3))
            for rows, f in batch_features(batch.column("text").to_pylist()):
                words[rows] += f.words
                n[rows] += np.bincount(f.text, minlength=len(rows))
                own = np.zeros(len(rows), np.int64)
                np.add.at(own, f.text, gain[f.bucket])
                total[rows] += own
            weight = total // np.maximum(n, 1)
            score = weight + np.array([gumbel(i, seed) for i in ids], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *map(pa.array, (words, n, weight, score))],
                names=["doc_id", "n_words", "n_features", "weight", "score"])
    return C.texts(docs, id_col, text_col).mapInArrow(run, SCORED)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
             seed: int = SEED) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)`` of every document;
    ``rank`` is NULL for one that is not drawn.

    Documents with at least ``min_words`` words take part; of these ``percent`` in
    a hundred are drawn.  They come first in one range-partitioned sort of the
    scores, so a place in that order is the rank and the number of documents that
    take part is all that is known besides: nothing is joined."""
    C.ready(docs.sparkSession)
    gain = gains(histogram(docs), histogram(target))
    takes_part = F.col("n_words") >= F.lit(min_words)
    scores = C.write_once(scored(docs, gain, seed), "scores")  # the sort reads them twice, for its ranges and for itself
    placed = with_position(scores, F.desc(takes_part), F.desc("score"),
                           F.asc_nulls_last("doc_id"), name="place")
    drawn = placed.agg(F.floor(F.count_if(takes_part) * percent / 100)).scalar()
    return placed.select("doc_id", "n_words", "n_features", "weight", "score",
                         F.when(F.col("place") <= drawn, F.col("place")).alias("rank"))
