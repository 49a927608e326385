"""Byte-level BPE encoding and decoding by recursive queries in each task.

A text is cut by the split pattern.  The distinct pieces of a batch that are no
single token become rows ``(word, pos, id)`` of an in-process DuckDB table; a
recursive query joins neighbouring rows with the merge table and contracts each
word's leftmost pair of minimum rank, until no word has a pair left.  Decoding
joins ids with the tokens' bytes and aggregates them in order of position.

A piece longer than ``LONG`` bytes would make the recursion carry its whole row
set through thousands of rounds, so it is contracted by the same rule with a
heap instead; results are the same.

Edge cases: a NULL or empty text has no tokens; very long texts are read whole;
special tokens in a text are ordinary text; equal rows get equal results; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common as C

CACHED_PIECES = 500_000  # pieces kept by one worker; it bounds memory only
QUERY_BYTES = 1 << 18    # bytes of pieces in one recursive query
LONG = 256               # bytes; positions must fit the query's packed number

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

#: A row names the position of the next one (``OUT``: none).  A pair's rank, its
#: two positions and the one after them are one number, so that ``min`` is the
#: leftmost pair of minimum rank.
OUT = 511
CONTRACT = f"""
WITH RECURSIVE step(word, pos, id, next, round) AS (
    SELECT word, pos, id, next, 0 FROM start
  UNION ALL
    SELECT p.word, p.pos, CASE WHEN p.pos = (b.best >> 18) & {OUT} THEN b.best >> 27 ELSE p.id END,
           CASE WHEN p.pos = (b.best >> 18) & {OUT} THEN b.best & {OUT} ELSE p.next END, p.round + 1
    FROM step p
    JOIN (SELECT l.word, min((m.rank << 27) | (l.pos << 18) | (l.next << 9) | r.next) AS best
          FROM step l JOIN step r ON r.word = l.word AND r.pos = l.next
          JOIN merges m ON m.a = l.id AND m.b = r.id
          GROUP BY l.word) b ON b.word = p.word
    WHERE p.pos <> (b.best >> 9) & {OUT}
), last AS (SELECT word, max(round) AS round FROM step GROUP BY word)
SELECT word, string_agg(CAST(s.id AS VARCHAR), ' ' ORDER BY s.pos), count(*), string_agg(t.hex, '' ORDER BY s.pos)
FROM step s JOIN last USING (word, round) JOIN tokens t ON t.id = s.id
GROUP BY word
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def contract(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The leftmost minimum-rank pair again and again, with a heap."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    after, before = [*range(1, len(parts)), -1], [-1, *range(len(parts) - 1)]
    heap = [(r, i, 2) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = after[i] if parts[i] else -1
        if j < 0 or len(parts[i]) + len(parts[j]) != size:
            continue  # one side has been contracted meanwhile
        parts[i], parts[j] = parts[i] + parts[j], b""
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right >= 0 and (r := ranks.get(parts[left] + parts[right])) is not None:
                heapq.heappush(heap, (r, left, len(parts[left]) + len(parts[right])))
    return [ranks[p] for p in parts if p]


class Coder:
    """One worker's DuckDB connection with the merge table, and a memo of pieces."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex
        self.split = regex.compile(pattern).findall
        self.ranks = ranks = read_ranks(path)
        self.by_id = {v: k for k, v in ranks.items()}
        self.byte_id = np.asarray([ranks[bytes([b])] for b in range(256)], np.int64)
        self.memo: dict[str, tuple[str, int, bytes]] = {}
        merges = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
                  if t[:i] in ranks and t[i:] in ranks]
        self.db = duckdb.connect(":memory:")
        self.db.execute("SET threads = 1")
        self.db.execute("SET memory_limit = '300MB'")
        self._load("merges", ("a", "b", "rank"), zip(*merges))
        self._load("tokens", ("id", "hex"), zip(*((r, t.hex()) for t, r in ranks.items())))

    def _load(self, name: str, columns: tuple[str, ...], values) -> None:
        view = pa.table([pa.array(v) for v in values], names=list(columns))
        self.db.register("view_in", view)
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM view_in")
        self.db.unregister("view_in")

    def _contracted(self, pieces: list[bytes]) -> list[tuple[int, str, int, str]]:
        """``(piece's place, ids, their number, decoded bytes in hex)`` by the recursive query."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.asarray([len(p) for p in pieces])
        first = np.cumsum(sizes) - sizes
        pos = np.arange(len(data)) - np.repeat(first, sizes)
        after = np.where(pos + 1 < np.repeat(sizes, sizes), pos + 1, OUT)
        self._load("start", ("word", "pos", "id", "next"),
                   (np.repeat(np.arange(len(pieces)), sizes), pos, self.byte_id[data], after))
        return self.db.execute(CONTRACT).fetchall()

    def learn(self, pieces: list[str]) -> dict[str, tuple[str, int, bytes]]:
        """``(ids joined by a space, their number, decoded bytes)`` of each piece."""
        out: dict[str, tuple[str, int, bytes]] = {}
        block, size = [], 0
        for piece in pieces:
            data = piece.encode()
            if data in self.ranks:  # the library looks the whole piece up first
                out[piece] = (str(self.ranks[data]), 1, self.by_id[self.ranks[data]])
            elif len(data) > LONG:
                ids = contract(data, self.ranks)
                out[piece] = (" ".join(map(str, ids)), len(ids), b"".join(map(self.by_id.__getitem__, ids)))
            else:
                block.append((piece, data))
                size += len(data)
            if block and (size >= QUERY_BYTES or piece is pieces[-1]):
                for w, ids, n, decoded in self._contracted([d for _, d in block]):
                    out[block[w][0]] = (ids, n, bytes.fromhex(decoded))
                block, size = [], 0
        return out

    def code(self, texts: list[str]) -> list[tuple[str, int, bytes]]:
        """``(ids joined by a space, their number, decoded bytes)`` of each text."""
        split = [self.split(t) for t in texts]
        memo = self.memo
        fresh = self.learn(sorted(set().union(*split).difference(memo))) if split else {}
        known = memo if len(memo) + len(fresh) <= CACHED_PIECES else None
        if known is not None:
            memo.update(fresh)
        out = []
        for pieces in split:
            found = [memo[p] if p in memo else fresh[p] for p in pieces] if known is None else [memo[p] for p in pieces]
            out.append((" ".join([f[0] for f in found]), sum([f[1] for f in found]), b"".join([f[2] for f in found])))
        for p in list(fresh)[:max(0, CACHED_PIECES - len(memo))] if known is None else ():
            memo[p] = fresh[p]
        return out


def coder(path: str, pattern: str) -> Coder:
    return C.kept_by(f"bpe {path}", lambda: Coder(path, pattern))


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids, decoded)``: the token ids, and the bytes they decode to."""
    def run(batch):
        rows = coder(ranks_path, pattern).code([(t or b"").decode() for t in batch.column("text").to_pylist()])
        ids = [[int(i) for i in r[0].split()] for r in rows]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())),
                                           pa.array([r[2] for r in rows], pa.binary())],
                                          names=["doc_id", "ids", "decoded"])
    return C.texts(docs).mapInArrow(C.per_batch(run, 2 << 20), "doc_id long, ids array<int>, decoded binary")


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per document; a narrow map."""
    def run(batch):
        rows = coder(ranks_path, pattern).code([(t or b"").decode() for t in batch.column("text").to_pylist()])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([hashlib.sha256(r[0].encode()).hexdigest() for r in rows], pa.string()),
             pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return C.texts(docs).mapInArrow(C.per_batch(run, 2 << 20), SCHEMA)
