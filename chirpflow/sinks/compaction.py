"""Compaction of micro-batch tables.

A 5-second stream leaves 17,280 partition folders a day.  ``compact`` copies the
closed batches of a table into a *segment*, a folder of files of the size that
Spark's scan packs, and then switches readers over by adding one version to the
table's log: a file that lists every segment and, per query, the last batch in
it.  The file appears by one rename, so a reader sees a batch in its own folder
or in a segment, never in both or in none.  ``append_batch`` asks the log before
it writes: a batch that is replayed after its compaction is left alone.

    path/query_id=Q/batch_id=N/...     batches not yet compacted
    path/_segments/ID/...              compacted batches, ids as columns
    path/_log/VERSION.json             the versions of the list

Names that begin with ``_`` are invisible to plain readers of ``path``, so read a
compacted table with ``read_batches``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import hadoop_fs

LOG, SEGMENTS = "_log", "_segments"


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, folder = hadoop_fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def table_log(spark: SparkSession, path: str) -> dict:
    """``version``, ``segments`` (folder names) and ``upto`` (query id -> last compacted batch)."""
    versions = [n for n in _children(spark, f"{path}/{LOG}") if n.endswith(".json")]
    if not versions:
        return {"version": 0, "segments": [], "upto": {}}
    return json.loads(spark.read.text(f"{path}/{LOG}/{versions[-1]}", wholetext=True).first()["value"])


def _commit(spark: SparkSession, path: str, log: dict) -> None:
    """Make ``log`` the next version.  Fails if another writer has made it."""
    final = f"{path}/{LOG}/{log['version']:012d}.json"
    fs, draft = hadoop_fs(spark, f"{path}/{LOG}/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(log, sort_keys=True).encode()))
    out.close()
    _, target = hadoop_fs(spark, final)
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise RuntimeError(f"another compaction has written {final}")


def batches(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """The batches that have a folder of their own, per query."""
    out = {}
    for query in (n for n in _children(spark, path) if n.startswith("query_id=")):
        own = [int(n[len("batch_id="):]) for n in _children(spark, f"{path}/{query}") if n.startswith("batch_id=")]
        out[query[len("query_id="):]] = sorted(own)
    return out


def is_compacted(spark: SparkSession, path: str, query_id: str, batch_id: int) -> bool:
    return batch_id <= table_log(spark, path)["upto"].get(query_id, -1)


def _in_segments(upto: dict[str, int]):
    covered = F.lit(False)
    for query, last in upto.items():
        covered |= (F.col("query_id") == query) & (F.col("batch_id") <= last)
    return covered


def _live(spark: SparkSession, path: str) -> DataFrame:
    """The batch folders, with the partition columns' types declared by a cast
    (an id of digits alone would be inferred as a number)."""
    return spark.read.parquet(path).withColumns({"query_id": F.col("query_id").cast("string"),
                                                 "batch_id": F.col("batch_id").cast("bigint")})


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a micro-batch table, each once, with ``query_id`` and ``batch_id``."""
    log = table_log(spark, path)
    frames = []
    if any(batches(spark, path).values()):
        frames.append(_live(spark, path).filter(~_in_segments(log["upto"])))
    if log["segments"]:
        frames.append(spark.read.parquet(*[f"{path}/{SEGMENTS}/{s}" for s in log["segments"]]))
    if not frames:
        raise FileNotFoundError(f"no batch under {path}")
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1], allowMissingColumns=True)


def compact(spark: SparkSession, path: str, upto: int | None = None) -> int:
    """Move the closed batches of every query into one new segment; returns their
    number.  Closed are all but a query's newest batch, which its checkpoint may
    replay, or those up to ``upto``.  Nothing is shuffled: a write task takes what
    the scan packs into one partition (``spark.sql.files.maxPartitionBytes``), so
    small files merge into files of about that size.  The batch folders stay for
    readers that have listed them; ``vacuum`` deletes them."""
    log = table_log(spark, path)
    moved = {}
    for query, own in batches(spark, path).items():
        last = own[-2] if upto is None and len(own) > 1 else upto
        new = [b for b in own if last is not None and log["upto"].get(query, -1) < b <= last]
        if new:
            moved[query] = new
    if not moved:
        return 0
    segment = uuid.uuid4().hex
    chosen = F.lit(False)
    for query, new in moved.items():
        chosen |= (F.col("query_id") == query) & F.col("batch_id").between(new[0], new[-1])
    _live(spark, path).filter(chosen).write.parquet(f"{path}/{SEGMENTS}/{segment}")
    _commit(spark, path, {"version": log["version"] + 1, "segments": [*log["segments"], segment],
                          "upto": log["upto"] | {q: new[-1] for q, new in moved.items()}})
    return sum(map(len, moved.values()))


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the folders of batches that are in segments, and segments of
    compactions that were never committed; returns the number of folders.  Run it
    when no reader from before the last compaction is left."""
    log = table_log(spark, path)
    gone = [f"{path}/query_id={q}/batch_id={b}" for q, own in batches(spark, path).items()
            for b in own if b <= log["upto"].get(q, -1)]
    gone += [f"{path}/{SEGMENTS}/{s}" for s in _children(spark, f"{path}/{SEGMENTS}") if s not in log["segments"]]
    for folder in gone:
        fs, target = hadoop_fs(spark, folder)
        fs.delete(target, True)
    return len(gone)
