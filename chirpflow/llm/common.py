"""Shared helpers of the operators: session set-up, text columns, written tables."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import hadoop_fs, ready, scratch_path

MASK64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables under ``sf_dir`` (any file system Spark reads)."""
    return ready(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_WRITTEN: list[str] = []


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.  This cuts the
    lineage: a lost executor costs a re-read, not a re-computation."""
    spark = df.sparkSession
    path = scratch_path(ready(spark), "llm", name)
    _WRITTEN.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written() -> list[str]:
    """The folders that ``write_once`` has made and nobody has freed."""
    return list(_WRITTEN)


def free(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders of ``write_once`` that no DataFrame in use reads any more."""
    for path in paths:
        fs, folder = hadoop_fs(spark, path)
        fs.delete(folder, True)
        if path in _WRITTEN:
            _WRITTEN.remove(path)


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)``, the text as UTF-8 bytes; a NULL text stays NULL.
    Every other column is dropped, so clashing names cannot matter."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))


def fold(id_col: Column, folds: int = 5) -> Column:
    """``crc32(id as text) mod folds``; NULL for a NULL id."""
    return F.crc32(id_col.cast("string").cast("binary")) % F.lit(folds)


_KEPT: dict[str, Any] = {}


def kept_by(owner: str, make: Callable[[], Any]) -> Any:
    """What a worker keeps between batches and tasks for one operator.  Workers
    live on when another operator's tasks come; the first of these drops it and
    gives the memory back, so neither caches nor free lists add up."""
    if owner not in _KEPT:
        if _KEPT:
            _KEPT.clear()
            give_back()
        _KEPT[owner] = make()
    return _KEPT[owner]


def give_back() -> None:
    """Return what the allocators hold free to the operating system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def small_batches(batches: Iterator[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Re-slice Arrow batches so that each holds about ``max_bytes`` of data and
    at least one row; the rows and their order stay as they are."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        if n == 1 or batch.nbytes <= max_bytes:
            yield batch
            continue
        sizes = np.full(n, batch.nbytes / n)
        for col in batch.columns:
            if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) or pa.types.is_string(col.type):
                lengths = pc.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False)
                sizes = lengths.astype(np.float64) + 64
                break
        block = (np.cumsum(sizes) // max_bytes).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], n]):
            yield batch.slice(int(a), int(b - a))


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch], max_bytes: int = 8 << 20):
    """A ``mapInArrow`` function that applies ``fn`` to bounded batches."""
    def run(batches):
        for batch in small_batches(batches, max_bytes):
            yield fn(batch)
    return run


BLOCK_BYTES = 8 << 20
BLOCKS = ("block long, rows array<long>, doc_ids array<long>, flags array<boolean>, sizes array<long>, "
          "data binary")


def text_blocks(docs: DataFrame, name: str, flag: Column | None = None,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents in blocks of about ``block_bytes`` of text, one row per block
    (``BLOCKS``), the texts one after the other under Zstandard; NULL counts as
    empty.  Written once: from here on a document's block and row number are
    fixed, whatever is computed again."""
    def run(batches):
        import zstandard
        from pyspark import TaskContext
        part, number, row = TaskContext.get().partitionId(), 0, 0
        pack = zstandard.ZstdCompressor(level=3)
        held: list[tuple] = []
        size = 0

        def close():
            ids, flags, data = zip(*held)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number]), pa.array([[(part << 33) + row + i for i in range(len(ids))]]),
                 pa.array([ids], pa.list_(pa.int64())), pa.array([flags], pa.list_(pa.bool_())),
                 pa.array([[len(t) for t in data]], pa.list_(pa.int64())),
                 pa.array([pack.compress(b"".join(data))], pa.binary())],
                names=["block", "rows", "doc_ids", "flags", "sizes", "data"])
        for batch in small_batches(batches):
            for doc_id, flag, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "flag", "text"))):
                held.append((doc_id, flag, text or b""))
                size += len(text or b"") + 64
                if size >= block_bytes:
                    yield close()
                    number, row, held, size = number + 1, row + len(held), [], 0
        if held:
            yield close()
    rows = docs.withColumn("flag", F.lit(False) if flag is None else flag).select("doc_id", "flag", "text")
    return write_once(rows.mapInArrow(run, BLOCKS), name)


def block_texts(row: dict) -> list[bytes]:
    """The texts of a block's row."""
    import zstandard
    data = zstandard.ZstdDecompressor().decompress(row["data"])
    ends = np.cumsum(row["sizes"]).tolist()
    return [data[b - n:b] for b, n in zip(ends, row["sizes"])]


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorting is several times as fast as the hash
    table that ``np.unique`` uses for them."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def packed(x: np.ndarray, ascending: bool = False) -> bytes:
    """An array's bytes, plane by plane, under Zstandard; ascending integers as
    differences.  Such arrays shrink to a half or a third before a shuffle."""
    import zstandard
    if ascending:
        x = np.diff(x, prepend=x.dtype.type(0))
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, kind: type, ascending: bool = False) -> np.ndarray:
    """The array that ``packed`` was given."""
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    x = np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()
    return np.cumsum(x, dtype=kind) if ascending else x


def bounded_sample(df: DataFrame, id_col: str, rows: int) -> DataFrame:
    """About ``rows`` rows of ``df``, chosen by a hash of the id, and never more
    than twice as many.  For fitting only."""
    n = df.count()
    if n <= rows:
        return df
    share = int(rows / n * (1 << 30))
    return df.filter(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)) < F.lit(share)).limit(2 * rows)
