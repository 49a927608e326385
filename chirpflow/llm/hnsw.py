"""Approximate nearest neighbours by one hierarchical small-world graph per shard.

Rows are dealt to shards by a hash; each shard's task builds a graph whose
layers are flat neighbour arrays, and the graphs are written as one row per
shard to the shared folder.  Queries, in blocks, search every shard's graph;
the shards' best rows are merged per query and their scores are exact inner
products in double precision of the original vectors.

The graph uses angles: a vector gets one more component, which makes all
lengths equal, so that the largest inner product is the smallest angle.  Points
are inserted in batches, each searched at once against the graph so far, so
inserting and searching are array operations.  A graph's points are the shard's
distinct vectors, so that copies neither link only to each other nor fill the
beam; a point found stands for its rows, of which those with the ``k + 1``
smallest ids are kept, enough for the ``k`` nearest of any row.  Every shard with
more points than a search's beam has a graph; with fewer the beam holds them all.
Only where a query finds too few points is a shard compared in full.

Edge cases: vectors that are NULL, zero, of another length than most, or hold a
NULL or non-finite component, and rows without an id, take no part; rows with
equal ids are separate candidates, and a query leaves out only its own row; equal
scores go to the smaller id; with fewer candidates than ``k`` all are returned;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

K, EVERY = 20, 20
LINKS, BUILD_BEAM, SEARCH_BEAM = 32, 64, 128
SHARDS, SHARD_ROWS = 1, 20_000    # at least so many shards, and at most about so many rows in one
RELINKED = 512                     # points whose links are chosen anew at once; bounds memory only
QUERY_BLOCK = 8192                 # queries one task holds


# ------------------------------------------------------------- flat graphs

def _sims(base: np.ndarray, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Inner products of each query with its own row of candidates (-1: none)."""
    s = np.einsum("qd,qkd->qk", queries, base[ids])
    s[ids < 0] = -np.inf
    return s


def _distinct(ids: np.ndarray) -> np.ndarray:
    """Each row's ids without repeats, largest first, padded with -1."""
    out = np.sort(ids, 1)[:, ::-1].copy()
    out[:, 1:][out[:, 1:] == out[:, :-1]] = -1
    return np.sort(out, 1)[:, ::-1]


def beam_search(base: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple:
    """Best-first search of all queries at once in one layer.  ``links`` is the
    flat neighbour array ``(points, degree)``; -1 pads.  Returns ids and
    similarities, best first, ``(queries, beam)``."""
    q = len(queries)
    ids = np.full((q, beam), -1, np.int64)
    sims = np.full((q, beam), -np.inf, np.float32)
    width = min(beam, entry.shape[1])
    ids[:, :width] = _distinct(entry[:, :width])
    sims[:, :width] = _sims(base, queries, ids[:, :width])
    done = ids < 0
    visited = np.zeros((q, len(base)), bool)
    rows = np.arange(q)
    r, c = np.nonzero(ids[:, :width] >= 0)
    visited[r, ids[r, c]] = True
    active = rows
    while len(active):
        pool = np.where(done[active], -np.inf, sims[active])
        pick = pool.argmax(1)
        go = pool[np.arange(len(active)), pick] > -np.inf
        active, pick = active[go], pick[go]
        if not len(active):
            break
        done[active, pick] = True
        near = links[ids[active, pick]]
        fresh = (near >= 0) & ~visited[active[:, None], near]
        near = np.where(fresh, near, -1)
        r, c = np.nonzero(fresh)
        visited[active[r], near[r, c]] = True
        s = _sims(base, queries[active], near)
        all_ids, all_sims = np.concatenate([ids[active], near], 1), np.concatenate([sims[active], s], 1)
        all_done = np.concatenate([done[active], near < 0], 1)
        top = np.argpartition(-all_sims, beam - 1, 1)[:, :beam]
        take = np.arange(len(active))[:, None]
        ids[active], sims[active], done[active] = all_ids[take, top], all_sims[take, top], all_done[take, top]
    order = np.argsort(-sims, 1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def _spread(base: np.ndarray, ids: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
    """Of each row's candidates, best first, keep those nearer to the point than
    to any already kept one, then fill up with the best of the rest."""
    n, m = ids.shape
    vec = base[ids]
    between = vec @ vec.transpose(0, 2, 1)
    kept = np.zeros((n, m), bool)
    for j in range(m):
        closest = np.where(kept, between[:, j, :], -np.inf).max(1)
        kept[:, j] = (ids[:, j] >= 0) & (closest < sims[:, j]) & (kept.sum(1) < keep)
    rank = np.argsort(~kept * 2 * m + np.arange(m), 1, kind="stable")[:, :keep]
    out = np.take_along_axis(np.where(ids >= 0, ids, -1), rank, 1)
    return np.pad(out, ((0, 0), (0, max(0, keep - out.shape[1]))), constant_values=-1)


def _insert(base: np.ndarray, links: np.ndarray, new: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
    """Link new points to their spread candidates, and those back to them."""
    degree = links.shape[1]
    own = _spread(base, ids, sims, degree // 2)
    links[new, :own.shape[1]] = own
    src, dst = np.repeat(new, own.shape[1]), own.ravel()
    ok = dst >= 0
    src, dst = src[ok], dst[ok]
    order = np.argsort(dst, kind="stable")
    src, dst = src[order], dst[order]
    starts = np.flatnonzero(np.r_[True, dst[1:] != dst[:-1]]) if len(dst) else np.zeros(0, np.int64)
    place = np.arange(len(dst)) - np.repeat(starts, np.diff(np.r_[starts, len(dst)]))
    points = dst[starts]
    for a in range(0, len(points), RELINKED):
        some = points[a:a + RELINKED]
        inside = slice(*np.searchsorted(dst, [some[0], some[-1] + 1]))
        d, s, p = dst[inside], src[inside], place[inside]
        row = np.searchsorted(some, d)
        used = (links[some] >= 0).sum(1)
        width = int((used + np.bincount(row, minlength=len(some))).max())
        cand = np.full((len(some), max(width, degree)), -1, np.int64)
        cand[:, :degree] = np.sort(links[some], 1)[:, ::-1]
        cand[row, used[row] + p] = s
        cand = _distinct(cand)
        full = (cand >= 0).sum(1) > degree
        links[some[~full]] = cand[~full][:, :degree]
        if full.any():
            c = cand[full]
            sim = _sims(base, base[some[full]], c)
            best = np.argsort(-sim, 1, kind="stable")[:, :3 * degree]
            c, sim = np.take_along_axis(c, best, 1), np.take_along_axis(sim, best, 1)
            links[some[full]] = _spread(base, c, sim, degree)


def build(base: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM, seed: int = 7) -> dict:
    """Layers of flat neighbour arrays, lowest first.  Point i reaches as many
    layers as the usual exponential draw gives it; layer 0 has twice the links."""
    n = len(base)
    rng = np.random.default_rng(seed)
    level = np.minimum((-np.log(rng.random(n)) / np.log(links)).astype(np.int64), 8) if n else np.zeros(0, np.int64)
    top = int(level.max()) if n else 0
    layers = [np.full((n, links * (2 if l == 0 else 1)), -1, np.int32) for l in range(top + 1)]
    order = np.argsort(-level, kind="stable")  # the upper layers' points come first, so each layer is searchable
    entry = order[:1]
    at = 1
    while at < n:
        size = min(n - at, at // 8 + 1, 1024)  # a batch is small beside the graph that it is searched against
        new = order[at:at + size]
        near = np.repeat(entry[None, :], len(new), 0)
        for l in range(top, -1, -1):
            here = new[level[new] >= l]
            width = beam if l <= level[new].max() else 1
            ids, sims = beam_search(base, layers[l], base[new], near, max(width, near.shape[1] if l else beam))
            if len(here):
                rows = np.flatnonzero(level[new] >= l)
                batch = base[here] @ base[here].T
                np.fill_diagonal(batch, -np.inf)
                many = min(beam // 2, len(here))
                twin = np.argpartition(-batch, many - 1, 1)[:, :many]
                both = np.concatenate([ids[rows], here[twin]], 1)
                s = np.concatenate([sims[rows], np.take_along_axis(batch, twin, 1)], 1)
                both[~np.isfinite(s)] = -1
                best = np.argsort(-s, 1, kind="stable")[:, :beam]
                _insert(base, layers[l], here, np.take_along_axis(both, best, 1), np.take_along_axis(s, best, 1))
            near = ids[:, :4]
            near = np.where(near < 0, entry[0], near)
        at += size
    return {"layers": layers, "entry": entry}


def search(base: np.ndarray, graph: dict, queries: np.ndarray, beam: int) -> np.ndarray:
    """Ids of the nearest points found, best first, ``(queries, beam)``; -1 pads."""
    out = []
    for a in range(0, len(queries), 512):
        q = queries[a:a + 512]
        near = np.repeat(graph["entry"][None, :], len(q), 0)
        for layer in reversed(graph["layers"][1:]):
            ids, _ = beam_search(base, layer, q, near, 4)
            near = np.where(ids < 0, graph["entry"][0], ids)
        out.append(beam_search(base, graph["layers"][0], q, near, beam)[0])
    return np.concatenate(out) if out else np.zeros((0, beam), np.int64)


# ---------------------------------------------------------------- on Spark

def vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(row, vec_id, v)`` of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = (embeddings.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
            .withColumn("row", F.monotonically_increasing_id())
            .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()))
    rows = rows.filter(finite).filter(F.exists("v", lambda x: x != 0))
    return C.write_once(rows, "vectors")


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(flat), -1) if len(flat) else np.zeros((0, 1))


def _lifted(v: np.ndarray, longest: float) -> np.ndarray:
    """Unit vectors whose angles order as the inner products do."""
    rest = np.sqrt(np.maximum(longest ** 2 - (v ** 2).sum(1), 0))
    return (np.c_[v, rest] / longest).astype(np.float32)


def points(v: np.ndarray, vec_id: np.ndarray, row: np.ndarray, keep: int) -> tuple:
    """Distinct vectors in order of their first row here, where each one's rows
    start (and the last ends), and those rows: the ``keep`` smallest ids of each."""
    _, first, point = np.unique(v + 0.0, axis=0, return_index=True, return_inverse=True)
    point = np.argsort(np.argsort(first))[point.ravel()]
    order = np.lexsort((row, vec_id, point))
    sizes = np.bincount(point, minlength=len(first))
    place = np.arange(len(v)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return v[np.sort(first)], np.r_[0, np.cumsum(np.minimum(sizes, keep))], order[place < keep]


def index(rows: DataFrame, shards: int, longest: float, k: int = K, beam: int = SEARCH_BEAM) -> DataFrame:
    """One graph per shard: ``(shard, graph)``, the graph as a compressed archive
    of its arrays, written to the shared folder."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("row")
        row, vec_id = t.column("row").to_numpy(), t.column("vec_id").to_numpy()
        v, starts, at = points(_matrix(t.column("v")), vec_id, row, k + 1)
        base = _lifted(v, longest)
        graph = build(base) if len(base) > beam else {"layers": [], "entry": np.zeros(1, np.int64)}
        out = io.BytesIO()
        np.savez(out, v=v, starts=starts, row=row[at], vec_id=vec_id[at],
                 entry=graph["entry"], **{f"layer{i}": x for i, x in enumerate(graph["layers"])})
        return pa.table({"shard": pa.array([t.column("shard")[0].as_py()], pa.int32()),
                         "graph": pa.array([out.getvalue()], pa.binary())})
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "row"), F.lit(shards)).cast("int"))
    return C.write_once(dealt.groupBy("shard").applyInArrow(run, "shard int, graph binary"), "hnsw")


def _candidates(q: pa.Table, blob: bytes, longest: float, k: int, beam: int) -> pa.Table:
    own = np.load(io.BytesIO(blob))
    v, starts, row, vec_id = own["v"], own["starts"], own["row"], own["vec_id"]
    sizes = np.diff(starts)
    qv, qrow, qid = _matrix(q.column("v")), q.column("row").to_numpy(), q.column("vec_id").to_numpy()
    layers = [own[f"layer{i}"] for i in range(sum(x.startswith("layer") for x in own.files))]
    if layers:
        found = search(_lifted(v, longest), {"layers": layers, "entry": own["entry"]},
                       np.c_[qv, np.zeros(len(qv))].astype(np.float32), beam)
    else:
        found = np.repeat(np.arange(len(v))[None, :], len(qv), 0)
    out_q, out_row, out_id, out_s = [], [], [], []
    for i in range(len(qv)):
        ids = found[i][found[i] >= 0]
        if len(ids) < min(k + 1, len(v)):  # the graph did not lead to enough points
            ids = np.arange(len(v))
        s, n = np.einsum("d,kd->k", qv[i], v[ids]), sizes[ids]
        ids = np.arange(n.sum()) + np.repeat(starts[ids] - np.cumsum(n) + n, n)  # the points' rows
        s, other = np.repeat(s, n), row[ids] != qrow[i]
        s, ids = s[other], ids[other]
        best = np.lexsort((vec_id[ids], -s))[:k]
        out_q.append(np.full(len(best), qrow[i]))
        out_row.append(np.full(len(best), qid[i]))
        out_id.append(vec_id[ids[best]])
        out_s.append(s[best])
    cat = (lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t))
    return pa.table({"query_row": cat(out_q, np.int64), "query_id": cat(out_row, np.int64),
                     "vec_id": cat(out_id, np.int64), "score": cat(out_s, np.float64)})


def nearest(embeddings: DataFrame, k: int = K, every: int = EVERY, beam: int = SEARCH_BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by
    ``every``, the ``k`` nearest of all other rows."""
    rows = vectors(embeddings)
    width = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dim = width[0]["d"] if width else 1
    rows = rows.filter(F.size("v") == dim)
    n, longest, queries = rows.agg(
        F.count(F.lit(1)), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))),
        F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    shards, blocks = max(SHARDS, -(-n // SHARD_ROWS)), max(1, -(-queries // QUERY_BLOCK))
    longest = float(longest or 1.0)
    graphs = index(rows, shards, longest, k, beam).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = (rows.filter(F.col("vec_id") % every == 0)
             .withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    schema = "query_row long, query_id long, vec_id long, score double"

    def run(q: pa.Table, g: pa.Table) -> pa.Table:
        if not len(q) or not len(g):
            return pa.table({c: pa.array([], t) for c, t in
                             (("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()),
                              ("score", pa.float64()))})
        return _candidates(q, g.column("graph")[0].as_py(), longest, k, beam)
    found = asked.groupBy("shard", "block").cogroup(graphs.groupBy("shard", "block")).applyInArrow(run, schema)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
