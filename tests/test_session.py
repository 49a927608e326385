"""Session factory and the shared scratch folder."""

from chirpflow.session import DEFAULT_CONF, ensure_checkpoint_dir, scratch_path


def test_checkpoint_dir_comes_from_session(spark):
    base = ensure_checkpoint_dir(spark)
    assert base == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1.startswith(f"{base}/chirpflow/{spark.sparkContext.applicationId}/x/") and p1 != p2
    assert scratch_path(spark, "y", unique=False) == f"{base}/chirpflow/{spark.sparkContext.applicationId}/y"


def test_defaults_enable_aqe_and_keep_ui_off(spark):
    assert DEFAULT_CONF["spark.ui.enabled"] == "false"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_kafka_reader_options_are_built_without_a_broker(spark):
    import pytest
    from chirpflow.sources.kafka import read_kafka_stream
    # The connector jar is not on this image's classpath: the reader fails at
    # load() with Spark's "data source not found" error, not in our code.
    with pytest.raises(Exception) as e:
        read_kafka_stream(spark, "localhost:9092", "tweets", min_partitions=64,
                          max_offsets_per_trigger=100000)
    assert "kafka" in str(e.value).lower()


def test_tune_shuffle_scales_with_input(spark):
    from chirpflow.session import tune_shuffle
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        cores = spark.sparkContext.defaultParallelism
        assert tune_shuffle(spark, 10 << 20) == 2 * cores
        assert tune_shuffle(spark, 100 << 40) == (100 << 40) // (128 << 20)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str((100 << 40) // (128 << 20))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_clear_scratch_removes_only_this_application(spark):
    import os
    from chirpflow.session import clear_scratch, input_bytes, local_fs_path
    path = scratch_path(spark, "test-clear")
    spark.range(5).write.parquet(path)
    other = f"{ensure_checkpoint_dir(spark)}/chirpflow/another-application/x"
    spark.range(1).write.mode("overwrite").parquet(other)
    assert input_bytes(spark.read.parquet(path)) > 0
    clear_scratch(spark)
    assert not os.path.exists(local_fs_path(path)) and os.path.exists(local_fs_path(other))
