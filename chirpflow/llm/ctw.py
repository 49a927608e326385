"""Language-model scores by context-tree weighting over bytes.

Each byte is eight binary decisions; a decision's node is a context of the last
0 to ``DEPTH`` bytes together with the bits already known.  Every node has a
Krichevsky-Trofimov estimate from its training counts, and the weighted
probability mixes the estimates of all depths, as context-tree weighting does:
half a node's own block probability plus half the product of its children's.
With the counts frozen, the probability of a byte depends on the last ``DEPTH``
bytes alone, so a text's score is a sum over its byte n-grams.

Spark job: documents are written once in blocks of bounded bytes.  Each block
sends its distinct n-grams and words, with training counts (0 where only unseen
texts hold them), to shards; n-grams go by their nearest three context bytes,
so that a shard holds whole subtrees.  Shards work out the levels from
``DEPTH`` to 3; levels 2 to 0 are DataFrame aggregations, and their mixture
weights come back by joins.  Each block then receives the log probabilities of
its own n-grams and the counts of its own words, in the order in which it sent
them.  Nothing that grows with the corpus is broadcast or held by one task.

Edge cases: a NULL or empty text is the end symbol alone; very long texts are
scored whole; texts with equal ids are separate rows; without training texts
every estimate is one half; an empty table gives an empty result; other columns
are ignored.  Words are matched by a 64-bit hash.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

DEPTH = 5                # bytes of context
TOP = 3                  # levels below this depth are DataFrame aggregations
BLOCK_BYTES = 14 << 20   # text in one block: larger ones send fewer n-grams twice, but a task holds one whole
GROUP = 256              # blocks that one task of a shard holds at once
CHUNK = 1 << 20          # n-grams worked on at once
END = 0xFF               # no byte of UTF-8 text; starts and ends every text
END_WORD = b" end"       # holds white space, so it is no word
LOG2 = math.log(2.0)
Folded = tuple[np.ndarray, np.ndarray]

SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double, n_bytes long, bits_per_byte double")


# ------------------------------------------------------------ the estimates

def lgamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive arguments (Stirling, shifted by 8)."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def kt_block(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log Krichevsky-Trofimov probability of a sequence with these counts."""
    return lgamma(n0 + 0.5) + lgamma(n1 + 0.5) - lgamma(n0 + n1 + 1.0) - math.log(math.pi)


def kt_block_column(n0: Column, n1: Column) -> Column:
    """The same as a column expression."""
    def lg(x):
        y, product = x + 8, x
        for k in range(1, 8):
            product = product * (x + k)
        series = 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5)) - 1 / (1680 * F.pow(y, 7))
        return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(product)
    return lg(n0 + 0.5) + lg(n1 + 0.5) - lg(n0 + n1 + 1.0) - math.log(math.pi)


def subtrees(grams: np.ndarray, counts: np.ndarray, least: int, depth: int = DEPTH) -> list[list[dict]]:
    """Per bit of the byte, the levels from ``depth`` to ``least``: node keys
    (context bytes, the nearest lowest, then the known bits), counts, log block
    and weighted probabilities, and where each finer node or n-gram hangs."""
    context, byte = grams >> np.uint64(8), (grams & np.uint64(255)).astype(np.int64)
    out = []
    for bit in range(8):
        node = (1 << bit) | (byte >> (8 - bit))
        one = (byte >> (7 - bit)) & 1
        key = (context << np.uint64(8)) | node.astype(np.uint64)
        n1, n0, children, levels = counts * one, counts * (1 - one), None, []
        for d in range(depth, least - 1, -1):
            keys, up = np.unique(key & np.uint64((1 << 8 * (d + 1)) - 1), return_inverse=True)
            n0, n1 = np.bincount(up, n0, len(keys)), np.bincount(up, n1, len(keys))
            own = kt_block(n0, n1)
            weighted = own if children is None else np.logaddexp(own, np.bincount(up, children, len(keys))) - LOG2
            levels.append({"keys": keys, "up": up, "n0": n0, "n1": n1, "own": own, "weighted": weighted,
                           "leaf": children is None})
            key, children = keys, weighted
        out.append(levels)
    return out


def mixed(levels: list[dict], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Probability of a one at each n-gram: ``a`` and ``b`` are, per node of the
    coarsest level, what the levels above add and the weight they leave."""
    for level in reversed(levels):
        w = np.ones(len(level["own"])) if level["leaf"] else np.exp(level["own"] - level["weighted"] - LOG2)
        p = (level["n1"] + 0.5) / (level["n0"] + level["n1"] + 1.0)
        a, b = (a + b * w * p)[level["up"]], (b * (1 - w))[level["up"]]
    return a


def log_probabilities(grams: np.ndarray, trees: list[list[dict]], above) -> np.ndarray:
    """Log10 probability of each n-gram's last byte; ``above(bit, keys)`` gives
    ``a, b`` of the coarsest level's nodes."""
    byte, total = (grams & np.uint64(255)).astype(np.int64), np.zeros(len(grams))
    for bit, levels in enumerate(trees):
        one = mixed(levels, *above(bit, levels[-1]["keys"]))
        total += np.log10(np.where((byte >> (7 - bit)) & 1, one, 1 - one))
    return total


# ------------------------------------------------------------ texts to keys

def grams_of(data: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the texts, in order, and how many each text has (its bytes and the end)."""
    pad = bytes([END])
    joined = np.frombuffer(b"".join(pad * depth + t + pad for t in data), np.uint8)
    sizes = np.asarray([len(t) + 1 for t in data], np.int64)
    n = len(joined) - depth
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(depth + 1):
        out = (out << np.uint64(8)) | joined[k:k + max(n, 0)]
    inside = np.ones(len(out), bool)
    starts = np.cumsum(sizes + depth)[:-1]  # n-grams that would reach over two texts
    for k in range(1, depth + 1):
        inside[starts - k] = False
    return out[inside], sizes


def chunks(data: list[bytes]):
    """The texts in runs of about ``CHUNK`` bytes, at least one text in each."""
    run, size = [], 0
    for t in data:
        if run and size + len(t) > CHUNK:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t) + 1
    if run:
        yield run


def merge(parts: list[Folded]) -> Folded:
    """Sorted distinct keys with their counts summed."""
    keys = np.concatenate([k for k, _ in parts]) if parts else np.zeros(0, np.uint64)
    counts = np.concatenate([c for _, c in parts]) if parts else np.zeros(0, np.int64)
    keys, at = np.unique(keys, return_inverse=True)
    return keys, np.bincount(at, counts, len(keys)).astype(np.int64)


def count_grams(train: list[bytes], other: list[bytes]) -> Folded:
    """Distinct n-grams of both lists, counted in the first."""
    parts = []
    for run in chunks(train):
        parts.append(np.unique(grams_of(run)[0], return_counts=True))
    for run in chunks(other):
        keys = C.distinct(grams_of(run)[0])
        parts.append((keys, np.zeros(len(keys), np.int64)))
    return merge(parts)


def word_key(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def distinct_words(data: list[bytes]) -> set[bytes]:
    out: set[bytes] = set()
    for t in data:
        out.update(t.split())
    return out


def count_words(train: list[bytes], other: list[bytes]) -> Folded:
    """Hashes of the distinct words of both lists and the end, counted in the first."""
    counts = Counter()
    for t in train:
        counts.update(t.split())
    for w in distinct_words(other).difference(counts):
        counts[w] = 0
    counts[END_WORD] = len(train)
    return merge([(np.fromiter(map(word_key, counts), np.uint64, len(counts)),
                   np.fromiter(counts.values(), np.int64, len(counts)))])


def shard_of_grams(grams: np.ndarray, shards: int) -> np.ndarray:
    """By the nearest three bytes of context, so that subtrees stay together."""
    x = ((grams >> np.uint64(8)) & np.uint64(0xFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def shard_of_words(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys % np.uint64(shards)).astype(np.int64)


def by_shard(keys: np.ndarray, shard: np.ndarray, shards: int):
    """Places of the keys in order of shard, then key, and each shard's end there."""
    return np.argsort(shard, kind="stable"), np.cumsum(np.bincount(shard, minlength=shards))


# ---------------------------------------------------------------- on Spark

SENT = "block long, shard int, grams binary, gram_n binary, words binary, word_n binary"


def sent(block: int, data: list[bytes], held: list[bool], shards: int) -> pa.Table:
    """A block's distinct keys with training counts, one row per shard."""
    train = [t for t, h in zip(data, held) if not h]
    other = [t for t, h in zip(data, held) if h]
    cols = {}
    for name, n, (keys, counts), shard_of in (("grams", "gram_n", count_grams(train, other), shard_of_grams),
                                              ("words", "word_n", count_words(train, other), shard_of_words)):
        at, ends = by_shard(keys, shard_of(keys, shards), shards)
        keys, counts, starts = keys[at], counts[at], np.r_[0, ends[:-1]]
        cols[name] = pa.array([C.packed(keys[a:b], True) for a, b in zip(starts, ends)], pa.binary())
        cols[n] = pa.array([C.packed(counts[a:b].astype(np.uint32)) for a, b in zip(starts, ends)], pa.binary())
    return pa.table({"block": pa.array(np.full(shards, block)), "shard": pa.array(np.arange(shards, dtype=np.int32)),
                     **cols})


def _pairs(t: pa.Table, keys: str, counts: str, kind: type) -> list[Folded]:
    return [(C.unpacked(k, np.uint64, True), C.unpacked(n, kind).astype(np.int64))
            for k, n in zip(t.column(keys).to_pylist(), t.column(counts).to_pylist())]


WORDS = "block long, shard int, word_n binary, tokens long, kinds long"


def _word_counts(t: pa.Table) -> pa.Table:
    """Per block the counts of a shard's words over all blocks, in the block's
    order; the first row also carries the shard's totals."""
    pairs = _pairs(t, "words", "word_n", np.uint32)
    words, n = merge(pairs)
    first = np.zeros(len(t), np.int64)
    first[:1] = 1
    return pa.table({"block": t.column("block"), "shard": t.column("shard"),
                     "word_n": pa.array([C.packed(n[np.searchsorted(words, w)]) for w, _ in pairs], pa.binary()),
                     "tokens": pa.array(first * int(n.sum())), "kinds": pa.array(first * int((n > 0).sum()))})


def _merged(t: pa.Table, kind: type) -> pa.Table:
    """A shard's n-grams with their counts summed (64-bit from here on)."""
    grams, n = merge(_pairs(t, "grams", "gram_n", kind))
    return pa.table({"shard": t.column("shard").slice(0, 1), "grams": pa.array([C.packed(grams, True)], pa.binary()),
                     "gram_n": pa.array([C.packed(n)], pa.binary())})


def _rows_of(t: pa.Table) -> Folded:
    return _pairs(t, "grams", "gram_n", np.int64)[0]


NODES = "shard int, bit int, key long, n0 double, n1 double, weighted double"


def _border(t: pa.Table) -> pa.Table:
    """The nodes of level ``TOP`` of a shard."""
    shard = t.column("shard")[0].as_py()
    parts = [(bit, levels[-1]) for bit, levels in enumerate(subtrees(*_rows_of(t), TOP))]
    n = sum(len(x["keys"]) for _, x in parts)
    join = np.concatenate
    return pa.table({"shard": pa.array(np.full(n, shard, np.int32)),
                     "bit": pa.array(join([np.full(len(x["keys"]), b, np.int32) for b, x in parts])),
                     "key": pa.array(join([x["keys"] for _, x in parts]).astype(np.int64)),
                     **{k: pa.array(join([x[k] for _, x in parts])) for k in ("n0", "n1", "weighted")}})


def from_above(border: DataFrame) -> DataFrame:
    """``(shard, bit, key, a, b)`` for each node of level ``TOP``: what the levels
    above it add to the mixture, and the weight they leave to it.  A node's bits
    start with a one at their own place, so its key tells the bit too."""
    levels, finer = [], border.select("key", "n0", "n1", F.col("weighted"))
    for d in range(TOP - 1, -1, -1):
        up = F.col("key").bitwiseAND(F.lit((1 << 8 * (d + 1)) - 1))
        summed = finer.groupBy(up.alias("key")).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"),
                                                    F.sum("weighted").alias("children"))
        own = kt_block_column(F.col("n0"), F.col("n1"))
        top = F.greatest("own", "children")
        finer = (summed.withColumn("own", own)
                 .withColumn("weighted", top + F.log(F.exp(F.col("own") - top) + F.exp(F.col("children") - top)) - LOG2))
        levels.append((d, finer))
    mixture = None
    for d, level in reversed(levels):
        w = F.exp(F.col("own") - F.col("weighted") - LOG2)
        p = (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1.0)
        own = level.select("key", (w * p).alias("wp"), (1 - w).alias("rest"))
        if mixture is None:
            mixture = own.select("key", F.col("wp").alias("a"), F.col("rest").alias("b"))
        else:
            up = own.withColumn("up", F.col("key").bitwiseAND(F.lit((1 << 8 * d) - 1)))
            mixture = (up.join(mixture.withColumnRenamed("key", "up"), "up")
                       .select("key", (F.col("a") + F.col("b") * F.col("wp")).alias("a"),
                               (F.col("b") * F.col("rest")).alias("b")))
    up = border.select("shard", "bit", "key",
                       F.col("key").bitwiseAND(F.lit((1 << 8 * TOP) - 1)).alias("up"))
    return up.join(mixture.withColumnRenamed("key", "up"), "up").select("shard", "bit", "key", "a", "b")


def _scored(t: pa.Table, above: pa.Table) -> pa.Table:
    """A shard's n-grams with log probabilities."""
    grams, counts = _rows_of(t)
    bit, key = above.column("bit").to_numpy(), above.column("key").to_numpy()
    a, b = above.column("a").to_numpy(), above.column("b").to_numpy()
    order = np.lexsort((key, bit))
    bit, key, a, b = bit[order], key[order], a[order], b[order]

    def find(which, keys):
        low, high = np.searchsorted(bit, which), np.searchsorted(bit, which + 1)
        at = low + np.searchsorted(key[low:high], keys.astype(np.int64))
        return a[at], b[at]
    logs = log_probabilities(grams, subtrees(grams, counts, TOP), find)
    return pa.table({"shard": t.column("shard"), "grams": t.column("grams"),
                     "logs": pa.array([C.packed(logs)], pa.binary())})


def _returned(asked: pa.Table, known: pa.Table) -> pa.Table:
    """Per block the log probabilities in the order of its n-grams."""
    grams = C.unpacked(known.column("grams")[0].as_py(), np.uint64, True)
    logs = C.unpacked(known.column("logs")[0].as_py(), np.float64)
    out = [C.packed(logs[np.searchsorted(grams, C.unpacked(x, np.uint64, True))])
           for x in asked.column("grams").to_pylist()]
    return pa.table({"block": asked.column("block"), "shard": asked.column("shard"),
                     "logs": pa.array(out, pa.binary())})


def _block_scores(block: pa.Table, known: pa.Table, shards: int, tokens: int, kinds: int) -> pa.Table:
    """Scores of one block's documents."""
    known, docs = known.sort_by("shard"), block.to_pylist()[0]
    data = [t.lower() for t in C.block_texts(docs)]
    parts = []
    for run in chunks(data):
        own, sizes = grams_of(run)
        uniq, back = np.unique(own, return_inverse=True)
        parts.append((uniq, back.astype(np.int32), np.cumsum(sizes) - sizes))
    grams = C.distinct(np.concatenate([uniq for uniq, _, _ in parts]))
    at, _ = by_shard(grams, shard_of_grams(grams, shards), shards)
    logs = np.empty(len(grams))
    logs[at] = np.concatenate([C.unpacked(x, np.float64) for x in known.column("logs").to_pylist() if x is not None])
    scores = [np.add.reduceat(logs[np.searchsorted(grams, uniq)][back], starts) for uniq, back, starts in parts]
    place = {w: i for i, w in enumerate([END_WORD, *distinct_words(data)])}
    keys = np.fromiter(map(word_key, place), np.uint64, len(place))
    words = C.distinct(keys)
    at, _ = by_shard(words, shard_of_words(words, shards), shards)
    counts = np.empty(len(words), np.int64)
    counts[at] = np.concatenate([C.unpacked(x, np.int64) for x in known.column("word_n").to_pylist() if x is not None])
    counts = counts[np.searchsorted(words, keys)]  # of each place, the end first
    base = np.log10((counts + 0.5) / (tokens + 0.5 * (kinds + 1)))
    n_tokens, n_known, base_scores = [], [], []
    for t in data:
        ids = np.fromiter(map(place.__getitem__, t.split()), np.int64)
        n_tokens.append(len(ids) + 1)
        n_known.append(int((counts[ids] > 0).sum() + (counts[0] > 0)))
        base_scores.append(float(base[ids].sum() + base[0]))
    score = np.concatenate(scores)
    sizes = np.asarray([len(t) for t in data], np.int64)
    return pa.table({"doc_id": pa.array(docs["doc_ids"], pa.int64()), "held_out": pa.array(docs["flags"]),
                     "n_tokens": pa.array(n_tokens, pa.int64()), "n_known": pa.array(n_known, pa.int64()),
                     "train_tokens": pa.array(np.full(len(data), tokens)), "base_score": pa.array(base_scores),
                     "score": pa.array(score), "n_bytes": pa.array(sizes),
                     "bits_per_byte": pa.array(-score / math.log10(2) / (sizes + 1))})


def score_texts(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per document: word counts, the unigram base score and the model's
    log10 probability of the whole text with its end."""
    spark = C.ready(docs.sparkSession)
    shards = shards or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    is_held = F.coalesce(C.fold(F.col("doc_id")) == 1, F.lit(False))
    held = C.text_blocks(C.texts(docs), "ctw_blocks", is_held, BLOCK_BYTES)

    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                data = [t.lower() for t in C.block_texts(row)]
                yield from sent(row["block"], data, row["flags"], shards).to_batches()
    asked = C.write_once(held.select("block", "flags", "sizes", "data").mapInArrow(send, SENT), "ctw_sent")
    n_blocks = asked.filter("shard = 0").count()
    groups = max(1, -(-n_blocks // GROUP))
    group = F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("part")
    counted = C.write_once(asked.select("block", "shard", "words", "word_n").groupBy("shard")
                           .applyInArrow(_word_counts, WORDS), "ctw_words")
    tokens, kinds = (int(x or 0) for x in counted.agg(F.sum("tokens"), F.sum("kinds")).first())
    schema = "shard int, grams binary, gram_n binary"
    merged = (asked.select("shard", "grams", "gram_n", group).groupBy("shard", "part")
              .applyInArrow(lambda t: _merged(t, np.uint32), schema))
    if groups > 1:
        merged = merged.groupBy("shard").applyInArrow(lambda t: _merged(t, np.int64), schema)
    merged = C.write_once(merged, "ctw_counts")

    def border_nodes(batches):
        for batch in C.small_batches(batches, 1 << 20):
            for i in range(batch.num_rows):
                yield from _border(pa.Table.from_batches([batch.slice(i, 1)])).to_batches()
    border = C.write_once(merged.select("shard", "grams", "gram_n").mapInArrow(border_nodes, NODES), "ctw_border")
    above = from_above(border)
    logs = C.write_once(merged.groupBy("shard").cogroup(above.groupBy("shard"))
                        .applyInArrow(_scored, "shard int, grams binary, logs binary"), "ctw_logs")
    tables = logs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    answers = (asked.select("block", "shard", "grams", group).groupBy("shard", "part")
               .cogroup(tables.groupBy("shard", "part"))
               .applyInArrow(_returned, "block long, shard int, logs binary"))
    known = answers.unionByName(counted.select("block", "shard", "word_n"), allowMissingColumns=True)
    return (held.groupBy("block").cogroup(known.groupBy("block"))
            .applyInArrow(lambda d, k: _block_scores(d, k, shards, tokens, kinds), SCHEMA))
