"""Shared helpers: packed arrays, text blocks, bounded batches and samples."""

import numpy as np
import pyarrow as pa
import pytest

from chirpflow.llm import common as C


@pytest.mark.parametrize("kind", [np.uint8, np.uint16, np.uint32, np.uint64, np.int64, np.float64])
def test_packed_arrays_come_back(kind):
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 4000):
        x = (rng.random(n) * 250).astype(kind)
        assert (C.unpacked(C.packed(x), kind) == x).all()
        if kind is not np.float64:
            up = np.sort(x)
            assert (C.unpacked(C.packed(up, True), kind, True) == up).all()
    big = np.sort(rng.integers(0, 2 ** 64, 1000, np.uint64, endpoint=False))
    assert (C.unpacked(C.packed(big, True), np.uint64, True) == big).all()
    assert (C.distinct(np.array([3, 1, 3, 2, 1])) == [1, 2, 3]).all() and len(C.distinct(np.zeros(0))) == 0


def test_text_blocks_hold_every_text_once(spark, edge_rows):
    docs = spark.createDataFrame([(d, t) for d, t, _ in edge_rows], "doc_id long, text string").repartition(3)
    blocks = C.text_blocks(C.texts(docs), "test_blocks", block_bytes=2000).collect()
    assert len(blocks) > 5
    got, rows = [], []
    for b in blocks:
        texts = C.block_texts(b.asDict())
        assert len(texts) == len(b.doc_ids) == len(b.rows) == len(b.flags)
        got += [(str(d), t.decode()) for d, t in zip(b.doc_ids, texts)]
        rows += b.rows
    assert sorted(got) == sorted((str(d), t or "") for d, t, _ in edge_rows)
    assert len(set(rows)) == len(rows) and len({b.block for b in blocks}) == len(blocks)


def test_small_batches_keep_rows_and_bound_bytes():
    data = [b"x" * n for n in (10, 5000, 0, 20, 9000, 30)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(data, pa.binary()), pa.array(range(7))], names=["t", "i"])
    parts = list(C.small_batches([batch], 4000))
    assert [x for p in parts for x in p.column("t").to_pylist()] == data and len(parts) > 2
    assert list(C.small_batches([batch.slice(0, 0)], 10)) == []


def test_sample_is_bounded_also_under_one_id(spark):
    rows = spark.range(1000).selectExpr("CASE WHEN id < 900 THEN 7 ELSE id END AS doc_id")
    assert C.bounded_sample(rows, "doc_id", 50).count() <= 100
    assert C.bounded_sample(rows, "doc_id", 5000).count() == 1000
