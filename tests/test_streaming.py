"""Streams: drained stream equals batch, checkpoint rerun adds nothing,
replayed micro-batch is idempotent."""

from pyspark.sql import functions as F

from chirpflow.plans import queries as Q
from chirpflow.session import scratch_path
from chirpflow.sinks.tables import append_batch
from chirpflow.streaming import jobs as S
from conftest import SF_SMALL


def _stream(spark):
    return Q._doc_stream(spark, SF_SMALL)


def test_stream_equals_batch(spark):
    got = Q.stream_tweet_shape(spark, SF_SMALL)
    want = Q.tweet_shape(spark, SF_SMALL)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_rerun_on_same_checkpoint_adds_nothing(spark):
    base = scratch_path(spark, "test-stream")
    df = S.shape_stream(_stream(spark), keep=["doc_id"])
    S.run_to_table(df, base + "/t", base + "/c")
    n1 = spark.read.parquet(base + "/t").count()
    S.run_to_table(S.shape_stream(_stream(spark), keep=["doc_id"]), base + "/t", base + "/c")
    assert spark.read.parquet(base + "/t").count() == n1 == 200


def test_replayed_batch_overwrites_its_partition(spark):
    path = scratch_path(spark, "test-replay")
    batch = Q.tweet_shape(spark, SF_SMALL)
    append_batch(batch, 0, path)
    append_batch(batch.limit(10), 1, path)
    append_batch(batch, 0, path)  # replay of batch 0
    counts = {r.batch_id: r.n for r in S.batch_counts(spark, path).collect()}
    assert counts == {0: 200, 1: 10}


def test_empty_batch_writes_nothing(spark):
    path = scratch_path(spark, "test-empty")
    append_batch(Q.tweet_shape(spark, SF_SMALL).limit(0), 0, path)
    import os
    from chirpflow.session import local_fs_path
    assert not os.path.exists(local_fs_path(path))


def test_catalog_table_over_batches(spark):
    path = scratch_path(spark, "test-catalog")
    name = "t_" + path.rsplit("/", 1)[-1]
    batch = Q.tweet_shape(spark, SF_SMALL)
    append_batch(batch.filter("doc_id < 50"), 0, path, table=name)
    append_batch(batch.filter("doc_id >= 50"), 1, path, table=name)
    assert spark.table(name).count() == 200


def test_stream_score_uses_saved_model(spark):
    out = Q.stream_score(spark, SF_SMALL)
    assert out.count() == 200
    assert out.filter(~F.col("prediction").isin(0.0, 1.0)).count() == 0


def test_production_trigger_is_five_seconds():
    assert S.PRODUCTION_TRIGGER == {"processingTime": "5 seconds"}


def test_crash_before_commit_replays_batch_without_duplicates(spark):
    import os

    from chirpflow.session import local_fs_path
    base = scratch_path(spark, "test-crash")
    src = base + "/in"
    Q._docs(spark, SF_SMALL).select("doc_id", "text").repartition(4).write.parquet(src)
    schema = spark.read.parquet(src).schema

    def run():
        stream = S.read_text_stream(spark, src, schema, max_files_per_trigger=1)
        S.run_to_table(stream, base + "/t", base + "/c", transform=Q._shape_batch)

    run()
    counts = {r.batch_id: r.n for r in S.batch_counts(spark, base + "/t").collect()}
    assert len(counts) == 4 and sum(counts.values()) == 200
    # Crash after the last batch wrote its rows but before it was committed.
    commits = local_fs_path(base + "/c/commits")
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    run()
    again = {r.batch_id: r.n for r in S.batch_counts(spark, base + "/t").collect()}
    assert again == counts
    assert spark.read.parquet(base + "/t").select("doc_id").distinct().count() == 200


def test_routing_per_micro_batch_equals_batch(spark):
    from chirpflow.operators.filters import routes_frame
    routes = routes_frame(spark, Q.DEMO_ROUTES)
    path = scratch_path(spark, "test-routed")
    S.run_to_table(Q._doc_stream(spark, SF_SMALL).select("text"), path + "/t", path + "/c",
                   transform=lambda batch: S.routed_frame(batch, routes))
    got = spark.read.parquet(path + "/t").drop("batch_id", "query_id")
    want = S.routed_frame(Q._docs(spark, SF_SMALL), routes)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_two_checkpoints_keep_each_others_rows(spark):
    path = scratch_path(spark, "test-two")
    table = "two_" + path.rsplit("/", 1)[-1]
    for part in ("a", "b"):
        stream = Q._doc_stream(spark, SF_SMALL).select("doc_id", "text")
        S.run_to_table(stream, path + "/t", f"{path}/c-{part}", table=table, transform=Q._shape_batch)
    assert spark.read.parquet(path + "/t").count() == 400 == spark.table(table).count()
    assert S.batch_counts(spark, path + "/t").count() == 2


def test_processing_time_trigger_runs_until_stopped(spark):
    path = scratch_path(spark, "test-trigger")
    raw = Q._doc_stream(spark, SF_SMALL).select("doc_id", "text")
    q = S.run_to_table(raw, path + "/t", path + "/c", trigger={"processingTime": "1 second"},
                       transform=Q._shape_batch)
    try:
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    assert spark.read.parquet(path + "/t").count() == 200


def test_kafka_contract_stream_to_table(spark):
    from chirpflow.sources.kafka import payload_text
    base = scratch_path(spark, "test-kafka-contract")
    docs = Q._docs(spark, SF_SMALL)
    # Rows in Kafka's source contract, as the broker would deliver them.
    (docs.select(F.lit(None).cast("binary").alias("key"), F.encode("text", "UTF-8").alias("value"),
                 F.lit("tweets").alias("topic"))
     .write.parquet(base + "/in"))
    schema = spark.read.parquet(base + "/in").schema
    texts = payload_text(S.read_text_stream(spark, base + "/in", schema))
    S.texts_to_table(texts, base + "/t", base + "/c", trigger=S.DRAIN_TRIGGER).awaitTermination()
    got = spark.read.parquet(base + "/t").drop("batch_id", "query_id")
    want = S.shape_stream(docs, clean=False)
    assert got.count() == 200 and got.exceptAll(want).count() == 0


def test_kafka_writer_needs_only_the_connector(spark):
    import pytest
    from chirpflow.operators.filters import routes_frame
    frame = S.routed_frame(Q._docs(spark, SF_SMALL), routes_frame(spark, Q.DEMO_ROUTES))
    path = scratch_path(spark, "test-kafka-writer")
    # Fails at the data-source lookup (no connector jar here), not in our code.
    with pytest.raises(Exception) as e:
        S.collect_to_kafka(Q._doc_stream(spark, SF_SMALL), routes_frame(spark, Q.DEMO_ROUTES),
                           "localhost:9092", path)
    assert "kafka" in str(e.value).lower()
    assert [f.name for f in frame.schema.fields] == ["key", "value", "topic"]


def test_rows_read_count_what_the_batch_step_drops(spark):
    base = scratch_path(spark, "test-counts")
    docs = Q._docs(spark, SF_SMALL).select("doc_id", "text")
    for i, keep in enumerate((50, 0, 200)):
        append_batch(docs, i, base + "/t", transform=lambda b, n=keep: b.filter(F.col("doc_id") < n), counts=base + "/c")
    append_batch(docs.limit(0), 3, base + "/t", counts=base + "/c")
    append_batch(docs.limit(7), 1, base + "/t", counts=base + "/c")  # replayed with other rows: replaced
    got = {r.batch_id: (r.rows_read, r.rows_written) for r in S.rows_per_batch(spark, base + "/c").collect()}
    assert got == {0: (200, 50), 1: (7, 7), 2: (200, 200), 3: (0, 0)}


def test_rows_read_where_the_step_reads_the_batch_twice(spark):
    from chirpflow.operators.filters import routes_frame
    base = scratch_path(spark, "test-counts-routed")
    routes = routes_frame(spark, Q.DEMO_ROUTES)
    docs = Q._docs(spark, SF_SMALL).select("text")
    append_batch(docs, 0, base + "/t", transform=lambda b: S.routed_frame(b, routes), counts=base + "/c")
    (row,) = S.rows_per_batch(spark, base + "/c").collect()
    assert (row.rows_read, row.rows_written) == (200, spark.read.parquet(base + "/t").count())


def test_progress_log_hears_every_batch(spark):
    import time

    from chirpflow.streaming.progress import log_progress, observe_rows
    base = scratch_path(spark, "test-progress")
    Q._docs(spark, SF_SMALL).select("doc_id", "text").repartition(3).write.parquet(base + "/in")
    stream = S.read_text_stream(spark, base + "/in", "doc_id long, text string", max_files_per_trigger=1)
    log = log_progress(spark)
    try:
        q = (observe_rows(stream.filter("doc_id % 2 = 0"), "even").writeStream.format("parquet")
             .option("path", base + "/t").option("checkpointLocation", base + "/c").trigger(availableNow=True).start())
        q.awaitTermination()
        for _ in range(100):
            rows = log.rows(q.id)
            if sum(r["rows_read"] for r in rows) == 200:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    assert sum(r["rows_read"] for r in rows) == 200 and sum(r["even"] for r in rows) == 100
    assert len({r["batch_id"] for r in rows}) >= 3


def _batch(spark, i):
    return spark.createDataFrame([(i, f"row {j}") for j in range(i + 1)], "n int, text string")


def _held(spark, path):
    from chirpflow.sinks.compaction import read_batches
    rows = read_batches(spark, path).collect()
    out = {}
    for r in rows:
        out.setdefault((r.query_id, r.batch_id), []).append(r.text)
    return {k: sorted(v) for k, v in out.items()}


def test_compaction_keeps_every_row_once(spark):
    from chirpflow.sinks import compaction as K
    path = scratch_path(spark, "test-compact")
    want = {}
    for query in ("a", "7"):
        for i in range(5):
            append_batch(_batch(spark, i), i, path, query_id=query)
            want[query, i] = [f"row {j}" for j in range(i + 1)]
    assert _held(spark, path) == want  # before any compaction
    assert K.compact(spark, path) == 8  # each query's newest batch stays open
    assert _held(spark, path) == want   # the folders are still there
    assert K.vacuum(spark, path) == 8 and K.batches(spark, path) == {"a": [4], "7": [4]}
    assert _held(spark, path) == want
    append_batch(_batch(spark, 9), 2, path, query_id="a")   # a replay after compaction
    assert K.batches(spark, path)["a"] == [4] and _held(spark, path) == want
    append_batch(_batch(spark, 1), 4, path, query_id="a")   # a replay of an open batch
    append_batch(_batch(spark, 5), 5, path, query_id="a")
    want["a", 4], want["a", 5] = ["row 0", "row 1"], [f"row {j}" for j in range(6)]
    assert _held(spark, path) == want
    assert K.compact(spark, path) == 1 and K.compact(spark, path) == 0
    assert K.compact(spark, path, upto=5) == 2 and K.vacuum(spark, path) == 3
    assert K.batches(spark, path) in ({"a": [], "7": []}, {}) and _held(spark, path) == want
    assert {r.batch_id: r.n for r in S.batch_counts(spark, path).filter("query_id = 'a'").collect()} == {
        0: 1, 1: 2, 2: 3, 3: 4, 4: 2, 5: 6}


def test_a_compaction_that_dies_changes_nothing(spark, monkeypatch):
    import pytest

    from chirpflow.sinks import compaction as K
    path = scratch_path(spark, "test-compact-crash")
    for i in range(3):
        append_batch(_batch(spark, i), i, path)
    before = _held(spark, path)
    monkeypatch.setattr(K, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        K.compact(spark, path)
    monkeypatch.undo()
    assert _held(spark, path) == before and K.table_log(spark, path)["version"] == 0
    assert K.vacuum(spark, path) == 1  # the segment that no version lists
    log = K.table_log(spark, path) | {"version": 1}
    K._commit(spark, path, log)
    with pytest.raises(RuntimeError):  # a second writer of the same version
        K._commit(spark, path, log)


def test_compacted_files_are_few(spark):
    from chirpflow.sinks import compaction as K
    from chirpflow.session import local_fs_path
    import glob
    path = scratch_path(spark, "test-compact-files")
    for i in range(12):
        append_batch(_batch(spark, i).repartition(2), i, path)
    K.compact(spark, path)
    local = local_fs_path(path)
    assert len(glob.glob(local + "/_segments/*/*.parquet")) * 3 < len(glob.glob(local + "/query_id=*/*/*.parquet"))


def test_stream_spread_over_partitions(spark):
    base = scratch_path(spark, "test-spread")
    stream = S.read_text_stream(spark, f"{SF_SMALL}/documents.parq[u]et", Q._docs(spark, SF_SMALL).schema, min_partitions=3)
    S.run_to_table(stream.select("doc_id", F.spark_partition_id().alias("p")), base + "/t", base + "/c")
    out = spark.read.parquet(base + "/t")
    assert out.count() == 200 and out.select("p").distinct().count() == 3
