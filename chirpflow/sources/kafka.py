"""Kafka source.

Spark's Kafka connector is a separate artifact
(``org.apache.spark:spark-sql-kafka-0-10``); it must be on the classpath of the
deployment.  The functions only build the reader; the payload projection works
on any frame with Kafka's column contract (``key, value, topic, partition,
offset, timestamp, timestampType``) and is tested on such frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def payload_text(df: DataFrame, keep_topic: bool = False) -> DataFrame:
    """The UTF-8 payload as ``text``."""
    cols = [F.col("value").cast("string").alias("text")]
    if keep_topic:
        cols.append(F.col("topic"))
    return df.select(*cols)


def read_kafka_stream(spark: SparkSession, servers: str, topic: str,
                      starting_offsets: str = "latest", min_partitions: int | None = None,
                      max_offsets_per_trigger: int | None = None, **options: str) -> DataFrame:
    """S3: subscribe to one topic; offsets are tracked by the query checkpoint.

    ``min_partitions`` lets Spark split a topic's offset ranges over more tasks
    than the topic has partitions (no shuffle; text work then uses every
    core), and ``max_offsets_per_trigger`` bounds a micro-batch after a
    backlog, so a restart after downtime does not build one giant batch.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in options.items():
        reader = reader.option(k, v)
    return payload_text(reader.load())


def read_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Batch read of a topic (earliest to latest)."""
    reader = (spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic))
    for k, v in options.items():
        reader = reader.option(k, v)
    return payload_text(reader.load())
