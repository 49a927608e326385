"""Kafka sink (K1, F10): null key, UTF-8 value, topic per row.

One frame carries every topic, so a single job publishes all routes (the
collectors ran one process per topic).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import to_utf8


def kafka_frame(df: DataFrame, topic: str | Column = "topic", text_col: str = "text") -> DataFrame:
    """Rows in the Kafka sink contract ``(key BINARY, value BINARY, topic STRING)``."""
    t = F.lit(topic) if isinstance(topic, str) and topic not in df.columns else (
        F.col(topic) if isinstance(topic, str) else topic)
    return df.select(F.lit(None).cast("binary").alias("key"),
                     to_utf8(text_col).alias("value"),
                     t.cast("string").alias("topic"))


def require_kafka(spark: SparkSession, servers: str) -> None:
    """Fail now, not in the first micro-batch, if the connector is not on the
    classpath.  Only resolves the data source; no broker is asked."""
    (spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("subscribe", "-").load())


def write_kafka(frame: DataFrame, servers: str, **options: str) -> None:
    """Batch publish of a ``kafka_frame``."""
    w = frame.write.format("kafka").option("kafka.bootstrap.servers", servers)
    for k, v in options.items():
        w = w.option(k, v)
    w.save()


def write_kafka_stream(frame: DataFrame, servers: str, checkpoint: str, trigger: dict | None = None,
                       **options: str):
    """Streaming publish of a ``kafka_frame``; offsets in ``checkpoint``."""
    w = (frame.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("checkpointLocation", checkpoint))
    for k, v in options.items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
