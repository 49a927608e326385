"""Near duplicates: n-gram Jaccard join with several global token orders.

A document is the set of its distinct five-word shingles (hashed to 64 bits).
Two documents link when ``100 * intersection >= threshold * union``.  A pair
that links shares a token within the first ``n - ceil(t n) + 1`` tokens of both
sets under *every* global order of the tokens, so a candidate must do so under
several: first by document frequency, rarest first, then by two hash orders.

1. Documents are written in blocks; a block sends the distinct tokens it holds,
   with its counts, to shards, which answer with a byte per token: the frequency
   over all documents, on a log scale.  A frequent token is counted per block
   first, so it is one number per block.  (Shards compare 32 bits of a token;
   a false match only changes its place in the order, never a result.)
2. Tokens of a single document cannot be shared.  A document with fewer than
   ``ceil(t n)`` other tokens has no partner and is done here.
3. Equal sets are one class, with its first row as representative.
4. Representatives post their prefix under the first order.  A posting carries
   its size and the largest partner size its position allows; postings without
   any possible partner in their list go.
5. Each list is first compared with one leader (linear work).  Verified links
   join lists into components.  Where a list still holds many pairs across
   components, its rows are compared with a few others at a time, as long as that
   joins components; the pairs across components that are left in a list are then
   compared too, so no link between components is lost.
6. A pair passes the other orders' prefix filters, then is verified on the sets.
7. Components by alternating large-star and small-star rounds.

Edge cases: a NULL text or one without words has an empty set and links with
nothing; with fewer than five words the whole sequence is one shingle; rows with
equal ids are separate nodes; very long texts are read whole; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

WORDS, THRESHOLD = 5, 75
CACHED_WORDS = 150_000     # bounds memory only
BLOCK_BYTES = 3 << 20      # of text; a block's arrays take several times as much
HOT_CODE, SALTS = 80, 16   # postings of tokens in about a thousand documents or more are salted
LEADERS, TURNS = 16, 6     # rows of a list that its others are compared with at once, and how often at most
PRIME, MIX = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F)
ORDERS = (np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93))


# -------------------------------------------------------------------- sets

class WordHashes(dict):
    """Word to 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = value
        return value


def shingles(text: bytes | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a whole text."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(C.kept_by("ngram_join", WordHashes).__getitem__, words), np.uint64, len(words))
    k = min(size, len(words))
    n = len(words) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = (out + h[i:i + n]) * PRIME
    out ^= out >> np.uint64(29)
    out *= MIX
    out ^= out >> np.uint64(32)
    return C.distinct(out)


def least_overlap(n: int, threshold: int = THRESHOLD) -> int:
    """Tokens a set of ``n`` must share with any partner."""
    return -(-threshold * n // 100)


def linked(a: np.ndarray, b: np.ndarray, na: int, nb: int, threshold: int = THRESHOLD) -> bool:
    """Whether two sets link; ``a`` and ``b`` hold at least the tokens both could share."""
    if (100 + threshold) * min(len(a), len(b)) < threshold * (na + nb):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return (100 + threshold) * both >= threshold * (na + nb)


def prefix(tokens: np.ndarray, n: int, order: np.uint64, threshold: int = THRESHOLD) -> np.ndarray:
    """A set's prefix under a hash order.  The ``n - len(tokens)`` tokens that no
    other document holds come first in every order."""
    keep = n - least_overlap(n, threshold) + 1 - (n - len(tokens))
    if keep >= len(tokens):
        return tokens
    at = np.argpartition((tokens * order) ^ ((tokens * order) >> np.uint64(31)), keep - 1)[:keep]
    return tokens[at]


# --------------------------------------------------------- document frequency

def shard_keys(tokens: np.ndarray, shards: int) -> np.ndarray:
    """Shard and 32 bits of each token, as one sortable number."""
    return ((tokens >> np.uint64(32)) % np.uint64(shards) << np.uint64(32)) | (tokens & np.uint64(0xFFFFFFFF))


def asked(texts: list[bytes | None], block: int, shards: int) -> pa.Table:
    """A block's distinct tokens with the number of its distinct sets that hold them."""
    sets = {xxhash.xxh3_128_digest(s.tobytes()): s for s in map(shingles, texts)}
    keys = shard_keys(np.concatenate([*sets.values(), np.zeros(0, np.uint64)]), shards)
    del sets
    keys, counts = np.unique(keys, return_counts=True)
    ends = np.searchsorted(keys, np.arange(1, shards + 1, dtype=np.uint64) << np.uint64(32))
    low, counts = keys.astype(np.uint32), np.minimum(counts, 65535).astype(np.uint16)
    starts = np.r_[0, ends[:-1]]
    return pa.table({"block": pa.array(np.full(shards, block)), "shard": pa.array(np.arange(shards, dtype=np.int32)),
                     "tokens": pa.array([C.packed(low[a:b], True) for a, b in zip(starts, ends)], pa.binary()),
                     "counts": pa.array([C.packed(counts[a:b]) for a, b in zip(starts, ends)], pa.binary())})


def answered(t: pa.Table) -> pa.Table:
    """Codes of the tokens of all blocks of a shard: 0 in one document, else one
    plus eight times the binary logarithm of the number of documents."""
    tokens = [C.unpacked(x, np.uint32, True) for x in t.column("tokens").to_pylist()]
    counts = np.concatenate([C.unpacked(x, np.uint16) for x in t.column("counts").to_pylist()])
    _, at = np.unique(np.concatenate(tokens), return_inverse=True)
    total = np.bincount(at, counts)
    codes = np.where(total < 2, 0, 1 + np.minimum(254, 8 * np.log2(np.maximum(total, 1)))).astype(np.uint8)[at]
    cuts = np.cumsum([len(x) for x in tokens])[:-1]
    return pa.table({"block": t.column("block"), "shard": t.column("shard"),
                     "codes": pa.array([C.packed(x) for x in np.split(codes, cuts)], pa.binary())})


SETS = "row long, doc_id long, n long, print binary, tokens binary, codes binary"


def block_sets(block: pa.Table, codes: pa.Table, shards: int, threshold: int) -> pa.Table:
    """Each document's set size and digest, and, where a partner is possible, its
    shareable tokens with their codes in the first order."""
    docs = block.to_pylist()[0]
    sets = [shingles(t) for t in C.block_texts(docs)]
    keys = shard_keys(np.concatenate([*sets, np.zeros(0, np.uint64)]), shards)
    known = C.distinct(keys)
    code = np.concatenate([C.unpacked(x, np.uint8) for x in codes.sort_by("shard").column("codes").to_pylist()])
    code = code[np.searchsorted(known, keys)] if len(keys) else np.zeros(0, np.uint8)
    del keys, known
    prints, kept, kept_codes, at = [], [], [], 0
    for s in sets:
        own, at = code[at:at + len(s)], at + len(s)
        prints.append(xxhash.xxh3_128_digest(s.tobytes()))
        shared = own > 0
        if not len(s) or int(shared.sum()) < least_overlap(len(s), threshold):
            kept.append(None)
            kept_codes.append(None)
            continue
        tokens, own = s[shared], own[shared]
        order = np.lexsort((tokens, own))
        kept.append(tokens[order].tobytes())
        kept_codes.append(own[order].tobytes())
    return pa.table({"row": pa.array(docs["rows"], pa.int64()), "doc_id": pa.array(docs["doc_ids"], pa.int64()),
                     "n": pa.array([len(s) for s in sets], pa.int64()), "print": pa.array(prints, pa.binary()),
                     "tokens": pa.array(kept, pa.binary()), "codes": pa.array(kept_codes, pa.binary())})


def document_sets(docs: DataFrame, threshold: int = THRESHOLD, shards: int | None = None) -> DataFrame:
    """One row per document (``SETS``), written once."""
    spark = docs.sparkSession
    shards = shards or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    held = C.text_blocks(C.texts(docs), "join_blocks", block_bytes=BLOCK_BYTES)

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield from asked(C.block_texts(row), row["block"], shards).to_batches()
    codes = (held.select("block", "sizes", "data")
             .mapInArrow(ask, "block long, shard int, tokens binary, counts binary")
             .groupBy("shard").applyInArrow(answered, "block long, shard int, codes binary"))
    return C.write_once(
        held.groupBy("block").cogroup(codes.groupBy("block"))
        .applyInArrow(lambda d, c: block_sets(d, c, shards, threshold), SETS), "join_sets")


# --------------------------------------------------------------- candidates

def salted(rows: DataFrame, by: str) -> DataFrame:
    """The many rows of a join in which one key may hold a third of them."""
    return rows.withColumn("salt", F.pmod(F.col(by), F.lit(SALTS)).cast("int"))


def repeated(keys: DataFrame) -> DataFrame:
    """The other side: one row per key, for each salt."""
    return keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def postings(classes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``(token, salt, row, n, most)`` of the first order's prefixes.  ``most`` is
    the largest partner whose first shared token can be this one."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in C.small_batches(batches, 1 << 20):
            cols: list[list[np.ndarray]] = [[], [], [], [], []]
            for row, n, tokens, codes in zip(*(batch.column(c).to_pylist() for c in ("row", "n", "tokens", "codes"))):
                own = np.frombuffer(tokens, np.uint64)
                first = n - len(own)
                keep = n - least_overlap(n, threshold) + 1 - first
                code = np.frombuffer(codes, np.uint8)[:keep]
                left = n - first - np.arange(keep)
                cols[0].append(own[:keep].view(np.int64))
                cols[1].append(np.where(code >= HOT_CODE, row % SALTS, -1).astype(np.int32))
                cols[2].append(np.full(keep, row))
                cols[3].append(np.full(keep, n))
                cols[4].append((100 + threshold) * left // threshold - n)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols],
                                             names=["token", "salt", "row", "n", "most"])
    return classes.select("row", "n", "tokens", "codes").mapInArrow(
        run, "token long, salt int, row long, n long, most long")


def with_list(posts: DataFrame, lists: DataFrame) -> DataFrame:
    """Join postings with one row per list (its ``hot`` flag spreads over salts)."""
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(-1)))
    return posts.join(lists.withColumn("salt", F.explode(salts)).drop("hot"), ["token", "salt"])


def possible(posts: DataFrame) -> DataFrame:
    """Postings that have a possible partner in their list, by sizes alone."""
    lists = (posts.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("least"),
                                        F.max("most").alias("top"), F.max(F.col("salt") >= 0).alias("hot"))
             .filter("size > 1"))
    return (with_list(posts, lists).filter((F.col("least") <= F.col("most")) & (F.col("n") <= F.col("top")))
            .select("token", "salt", "row", "n", "most"))


def leader_pairs(posts: DataFrame) -> DataFrame:
    """Each posting with the first row of its list."""
    lists = posts.groupBy("token").agg(F.min(F.struct("row", "n", "most")).alias("lead"),
                                       F.max(F.col("salt") >= 0).alias("hot"))
    pairs = with_list(posts, lists).filter(
        (F.col("lead.row") < F.col("row")) & (F.col("lead.n") <= F.col("most")) & (F.col("n") <= F.col("lead.most")))
    return pairs.select(F.col("lead.row").alias("a"), F.col("row").alias("b")).distinct()


def mixed_lists(posts: DataFrame, labels: DataFrame) -> DataFrame:
    """The postings, with their component, of lists that hold several components."""
    named = posts.join(labels.withColumnRenamed("node", "row"), "row", "left").select(
        "token", "salt", "row", "n", "most", F.coalesce("label", "row").alias("label"))
    mixed = (named.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"))
             .filter("low < high").select("token"))
    return C.write_once(named.join(mixed, "token", "left_semi"), "join_mixed")


def crossing_count(left: DataFrame) -> tuple[int, int]:
    """The postings of mixed lists, and the pairs across components in them."""
    own = left.groupBy("token", "label").agg(F.count(F.lit(1)).cast("double").alias("k"))
    lists = own.groupBy("token").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("same"))
    found = lists.agg(F.sum("k").alias("k"), (F.sum(F.col("k") * F.col("k") - F.col("same")) / 2).alias("pairs")).first()
    return int(found.k or 0), int(found.pairs or 0)


def sampled_pairs(left: DataFrame, turn: int) -> DataFrame:
    """Each posting with up to ``LEADERS`` rows of its list in other components,
    other ones at each turn: linear work."""
    place = F.xxhash64("row", F.lit(turn))
    lists = (left.groupBy("token", F.pmod(place, F.lit(LEADERS)).alias("seat"))
             .agg(F.min(F.struct(place.alias("place"), "row", "n", "most", "label")).alias("lead"),
                  F.max(F.col("salt") >= 0).alias("hot")))
    hot = lists.groupBy("token").agg(F.max("hot").alias("hot"))
    pairs = with_list(left, lists.drop("hot").join(hot, "token")).filter(
        (F.col("lead.label") != F.col("label")) & (F.col("lead.n") <= F.col("most")) & (F.col("n") <= F.col("lead.most")))
    return pairs.select(F.least("lead.row", "row").alias("a"), F.greatest("lead.row", "row").alias("b")).distinct()


def merged(posts: DataFrame, links: DataFrame, classes: DataFrame,
           threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links, components and the mixed lists that are left, when comparing with a few
    rows of each list no longer joins components.  Rows of a large group of near
    copies link with some of its rows only, so one leader leaves many of them apart,
    and the pairs across components would grow with the square of the group."""
    labels = components(links)
    left = mixed_lists(posts, labels)
    size, pairs = crossing_count(left)
    for turn in range(TURNS):
        if pairs <= LEADERS * size / 4:
            break
        found = verified(sampled_pairs(left, turn), classes, threshold)
        links = links.union(found)
        labels = components(links)
        left = mixed_lists(left.drop("label"), labels)
        before, (size, pairs) = pairs, crossing_count(left)
        if pairs > 0.75 * before:
            break
    return links, labels, left


def crossing_pairs(left: DataFrame) -> DataFrame:
    """Pairs that share a list but no component."""
    right = left.select("token", *(F.col(c).alias(f"{c}_b") for c in ("row", "n", "most", "label")))
    pairs = left.join(right, (left["token"] == right["token"]) & (F.col("row") < F.col("row_b"))
                      & (F.col("label") != F.col("label_b")) & (F.col("n_b") <= F.col("most"))
                      & (F.col("n") <= F.col("most_b")))
    return pairs.select(F.col("row").alias("a"), F.col("row_b").alias("b")).distinct()


def verified(pairs: DataFrame, classes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs that pass the other orders' filters and then link."""
    pairs = C.write_once(pairs, "join_pairs")  # its size is known now: Spark broadcasts it if it is small
    own = classes.select("row", "n", "tokens")
    wide = (pairs.join(own.toDF("a", "na", "ta"), "a").join(own.toDF("b", "nb", "tb"), "b")
            .select("a", "b", "na", "nb", "ta", "tb"))

    def run(batches):
        for batch in C.small_batches(batches, 2 << 20):
            keep, seen = [], {}
            for a, b, na, nb, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "na", "nb", "ta", "tb"))):
                for row, n, raw in ((a, na, ta), (b, nb, tb)):
                    if row not in seen:
                        tokens = np.frombuffer(raw, np.uint64)
                        seen[row] = tokens, [prefix(tokens, n, o, threshold) for o in ORDERS]
                (xa, pa_), (xb, pb) = seen[a], seen[b]
                keep.append(all(len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(pa_, pb))
                            and linked(xa, xb, na, nb, threshold))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return C.write_once(wide.mapInArrow(run, "a long, b long"), "join_links")


# --------------------------------------------------------------- components

def components(links: DataFrame) -> DataFrame:
    """``(node, label)``: the smallest node reachable from each node that has a
    link, by alternating large-star and small-star rounds.  Each round is written
    to the shared folder, which also cuts the lineage."""
    def star(edges: DataFrame, name: str) -> DataFrame:
        """Hang each row's neighbour ``v`` under the least of ``u`` and its neighbours."""
        salt = F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")
        least = (edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
                 .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
        return edges.withColumn("salt", salt).join(least, ["u", "salt"])

    def turned(e: DataFrame) -> DataFrame:
        return e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = C.write_once(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                         "component_edges")
    state = None
    while True:
        large = star(turned(edges), "large").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        hung = star(down, "small")
        small = (hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(hung.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        edges = C.write_once(small, "component_edges")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    named = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return named.union(edges.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, row, n_shingles, class_id, component_id``.
    ``class_id`` is the first row with an equal set."""
    C.ready(docs.sparkSession)
    sets = document_sets(docs, threshold)
    slim = sets.select("row", "doc_id", "n", "print")
    equal = (slim.filter("n > 0").groupBy("print").agg(F.min("row").alias("class_id"), F.min("doc_id").alias("least"),
                                                       F.count(F.lit(1)).alias("size")))
    several = equal.filter("size > 1").select("print", "class_id")
    copies = C.write_once(  # rows that another row of their class stands for
        salted(slim, "row").join(repeated(several), ["print", "salt"])
        .filter("row <> class_id").select("row"), "join_copies")
    classes = C.write_once(sets.filter("tokens IS NOT NULL").join(copies, "row", "left_anti")
                           .select("row", "n", "tokens", "codes"), "join_classes")
    posts = C.write_once(possible(postings(classes, threshold)), "join_postings")
    links = verified(leader_pairs(posts), classes, threshold)
    links, labels, left = merged(posts, links, classes, threshold)
    more = verified(crossing_pairs(left), classes, threshold)
    labels = components(links.union(more))
    # Classes carry their smallest id; a component's id is the smallest of its classes'.
    grouped = (equal.join(labels.withColumnRenamed("node", "class_id"), "class_id", "left")
               .select("print", "class_id", "least", "size", F.coalesce("label", "class_id").alias("label")))
    lowest = (grouped.groupBy("label").agg(F.min("least").alias("lowest"), F.count(F.lit(1)).alias("classes"))
              .filter("classes > 1").select("label", "lowest"))
    ids = (salted(grouped, "class_id").join(repeated(lowest), ["label", "salt"], "left")
           .withColumn("component_id", F.coalesce("lowest", "least")))
    # Only classes of several rows or with a link differ from their own row's id; they are joined back.
    told = (ids.filter((F.col("size") > 1) | (F.col("component_id") != F.col("least")))
            .select("print", "class_id", "component_id"))
    return (salted(slim, "row").join(repeated(told), ["print", "salt"], "left")
            .select("doc_id", "row", F.col("n").alias("n_shingles"), F.coalesce("class_id", "row").alias("class_id"),
                    F.coalesce("component_id", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with its columns, one row of each component: the one with the
    smallest ``doc_id`` (NULL last), or the first read of these.  ``docs`` must
    be read from files, so that its rows have the same order each time."""
    row = "__row__"
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    found = near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text"), threshold)
    ids = numbered.select(F.col(row), F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("__id__"))
    grouped = (found.select(F.col("doc_id").alias(row), "component_id")
               .join(ids, row).groupBy("component_id")
               .agg(F.min(F.struct("__id__", row)).alias("first"), F.count(F.lit(1)).alias("size")))
    groups = grouped.filter("size > 1").select("component_id", F.col(f"first.{row}").alias("stays"))
    # Only rows of groups can go; their list is small against the documents and is joined by row.
    members = found.select(F.col("doc_id").alias(row), "component_id")
    gone = (salted(members, row).join(repeated(groups), ["component_id", "salt"])
            .filter(F.col(row) != F.col("stays")).select(row))
    return numbered.join(C.write_once(gone, "join_gone"), row, "left_anti").drop(row)
