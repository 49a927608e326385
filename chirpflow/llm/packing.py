"""Packing by concatenate and cut.

Pass 1 tokenizes every document and writes its ids, with the partition it fell
into and its start among that partition's tokens.  The partitions' totals give
each partition's global offset (a prefix sum over one number per partition).
Pass 2 adds that offset and cuts the stream of all tokens into windows of
``window`` ids; a document that crosses a window boundary gives one boundary
record per window.  Only the last window needs padding.

Edge cases: a NULL or empty text is the end id alone; documents with equal ids
or texts are separate; an empty table gives an empty result; a document longer
than a window covers several; bytes that are not UTF-8 count as U+FFFD; other
columns are ignored.
"""

from __future__ import annotations

import string
import zlib
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import common as C

WINDOW, END_ID = 2048, 1
#: Word spellings kept by one worker.  It bounds memory only: others are encoded again.
CACHED_WORDS = 500_000
#: Words that are encoded together; a token costs less than a call.
LINE_WORDS = 64


class WordEncoder:
    """Ids of a text, as the tokenizer gives them, through a memo of words.

    The tokenizer splits at white space and drops it, and neither its
    normalization nor its merges reach across an ASCII white-space character,
    so a text's ids are its words' ids in order."""

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.cached_words = cached_words
        self.memo: dict[bytes, bytes] = {}
        normalizer, letters = self.tokenizer.normalizer, string.ascii_uppercase
        marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Whether the case of ASCII texts without a special token's mark is lost anyway.
        self.lowers = (normalizer is not None and normalizer.normalize_str(letters) == letters.lower()
                       and all("<|" in m for m in marks))

    def encode(self, data: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [(t.lower() if self.lowers and t.isascii() and b"<|" not in t else t).split() for t in data]
        words = list(chain.from_iterable(split))
        known = list(map(self.memo.get, words))
        gaps = [i for i, ids in enumerate(known) if ids is None]
        fresh = self.fresh(list({words[i] for i in gaps}))
        for i in gaps:
            known[i] = fresh[words[i]]
        room = max(0, self.cached_words - len(self.memo))
        self.memo.update(fresh if len(fresh) <= room else dict(list(fresh.items())[:room]))
        ends = list(accumulate(map(len, split)))
        return [b"".join(known[a:b]) for a, b in zip([0, *ends], ends)]

    def fresh(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct words, a line of ``LINE_WORDS`` words at a time: a token's
        offset tells its word.  Words that hold a special token's mark go alone."""
        out = {}
        plain = [w for w in words if b"<|" not in w]
        lines = [plain[a:a + LINE_WORDS] for a in range(0, len(plain), LINE_WORDS)]
        lines += [[w] for w in words if b"<|" in w]
        for own in lines:
            texts = [w.decode(errors="replace") for w in own]
            line = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            ids, at = np.asarray(line.ids, "<u4").tobytes(), [a for a, _ in line.offsets]
            following = np.cumsum([len(text) + 1 for text in texts])
            ends = (4 * np.searchsorted(np.asarray(at, np.int64), following)).tolist()
            out.update(zip(own, [ids[a:b] for a, b in zip([0, *ends], ends)]))
        return out


def encoder(path: str, cached_words: int = CACHED_WORDS) -> WordEncoder:
    return C.kept_by(f"packing {path} {cached_words}", lambda: WordEncoder(path, cached_words))


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID,
              cached_words: int = CACHED_WORDS) -> DataFrame:
    """Pass 1: ``(part, local_start, doc_id, n, ids)``.  ``ids`` are little-endian
    and unsigned: 16 bits where the vocabulary allows it, else 32."""
    def run(batches):
        from pyspark import TaskContext
        part, at = TaskContext.get().partitionId(), 0
        enc = encoder(tokenizer_path, cached_words)
        narrow = enc.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16
        for batch in C.small_batches(batches, 2 << 20):
            ids = enc.encode([t or b"" for t in batch.column("text").to_pylist()])
            tail = np.asarray([end_id], "<u4").tobytes()
            n = np.asarray([len(x) // 4 + 1 for x in ids], np.int64)
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            packed = [np.frombuffer(x + tail, "<u4").astype("<u2").tobytes() if narrow else x + tail for x in ids]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), part, np.int32)), pa.array(starts), batch.column("doc_id"), pa.array(n),
                 pa.array(packed, pa.binary())], names=["part", "local_start", "doc_id", "n", "ids"])
    return C.texts(docs).mapInArrow(run, "part int, local_start long, doc_id long, n long, ids binary")


def cut(batch: pa.RecordBatch, window: int, with_ids: bool) -> pa.RecordBatch:
    """Boundary records of each row's ids in the windows they cross."""
    out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
    if not with_ids:
        del out["ids"]
    for doc, n, g, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "start", "ids"))):
        ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4").tobytes()
        at = 0
        while at < n:
            seq, off = divmod(g + at, window)
            length = min(window - off, n - at)
            piece = ids[4 * at:4 * (at + length)]
            for k, v in zip(out, (doc, at, length, zlib.crc32(piece), n, seq, off, piece)):
                out[k].append(v)
            at += length
    types = [pa.binary() if k == "ids" else pa.int64() for k in out]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID,
         with_ids: bool = True, cached_words: int = CACHED_WORDS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` and, if asked for, ``ids`` (little-endian unsigned 32 bits).

    ``cached_words`` bounds the memory of a worker's memo; the ids do not depend on it.

    The ids are written once to the shared folder, so the partition numbers that
    carry the offsets stay fixed whatever is recomputed later.  The prefix sum
    runs over one row per partition of the input, not over documents; that
    table (16 bytes per input partition) is the only thing broadcast."""
    rows = C.write_once(tokenized(docs, tokenizer_path, end_id, cached_words), "packed_ids")
    totals = rows.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = rows.join(F.broadcast(bases), "part").select("doc_id", "n", (F.col("base") + F.col("local_start")).alias("start"), "ids")
    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long" + ", ids binary" * with_ids)
    return placed.mapInArrow(C.per_batch(lambda b: cut(b, window, with_ids)), schema)
