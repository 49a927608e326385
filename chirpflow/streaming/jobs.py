"""Stream jobs.

The stream-to-table job is ``readStream -> payload -> shape -> foreachBatch
append``.  Offsets and progress live in the query checkpoint (T6), so a
restarted query resumes where it stopped and a replayed batch overwrites its own
partition.  Transformations are stateless: the same functions serve batch frames.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from .. import constants as C
from ..functions.text import clean_tweet, shape
from ..operators.features import Profile
from ..operators.filters import keyword_route
from ..operators.models import score_texts
from ..sinks.kafka import kafka_frame, require_kafka, write_kafka
from ..sinks.compaction import compact, read_batches, vacuum
from ..sinks.tables import append_batch
from ..sources.files import SPREAD_SETTING
from ..sources.kafka import read_kafka_stream
from ..sources.models import load_model

# The production trigger.  Queries and tests use availableNow.
PRODUCTION_TRIGGER = {"processingTime": C.MICRO_BATCH_INTERVAL}
DRAIN_TRIGGER = {"availableNow": True}


def read_text_stream(spark: SparkSession, path: str, schema: StructType | str,
                     fmt: str = "parquet", max_files_per_trigger: int = 1000,
                     min_partitions: int | None = None) -> DataFrame:
    """A file stream with a declared schema (a stand-in for the Kafka source:
    the payload is already a ``text`` column), in micro-batches of bounded size.
    ``min_partitions`` (or the session's ``SPREAD_SETTING``) spreads the rows of
    files that Spark cannot split over that many tasks, as Kafka's ``minPartitions``
    does; it costs a shuffle of the columns read."""
    stream = (spark.readStream.schema(schema).format(fmt)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(path))
    parts = min_partitions or spark.conf.get(SPREAD_SETTING, None)
    return stream.repartition(int(parts)) if parts else stream


def shape_stream(df: DataFrame, keep: Sequence[str] = (), clean: bool = True,
                 text_col: str = "text") -> DataFrame:
    """T2 + P8: ``(*keep, text, words, length)``; ``clean`` applies F3 first."""
    text = clean_tweet(text_col) if clean else F.col(text_col)
    return df.select(*keep, *shape(text))


def run_to_table(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                 table: str | None = None, wait: bool | None = None,
                 transform: Callable[[DataFrame], DataFrame] | None = None, counts: str | None = None,
                 compact_every: int | None = None) -> StreamingQuery:
    """T3 + T4 + T6 + K2: append every micro-batch to the table at ``path``.
    ``transform`` is an optional stateless per-batch step and ``counts`` a folder
    for the rows read and written per batch (see ``append_batch``).  After every
    ``compact_every`` batches the closed ones are compacted, and the folders of
    the compaction before are deleted: readers have that long to finish.
    With the default drain trigger the call blocks until the input is consumed."""
    trig = trigger or DRAIN_TRIGGER
    started, query = threading.Event(), []

    def append(batch: DataFrame, batch_id: int) -> None:
        started.wait()  # the first batch may come before start() has returned
        append_batch(batch, batch_id, path, table, query_id=query[0].id, transform=transform, counts=counts)
        if compact_every and batch_id and batch_id % compact_every == 0:
            vacuum(batch.sparkSession, path)
            compact(batch.sparkSession, path)
    query.append(df.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(**trig).start())
    started.set()
    if wait is None:
        wait = bool(trig.get("availableNow") or trig.get("once"))
    if wait:
        query[0].awaitTermination()
    return query[0]


def batch_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows per micro-batch in a table written by ``run_to_table``."""
    return (read_batches(spark, path).groupBy("query_id", "batch_id")
            .agg(F.count(F.lit(1)).alias("n")))


def rows_per_batch(spark: SparkSession, counts: str) -> DataFrame:
    """A2/T5: ``(query_id, batch_id, rows_read, rows_written)``, a row per
    micro-batch that ``run_to_table(counts=...)`` was given, empty ones too."""
    return read_batches(spark, counts).select("query_id", "batch_id", "rows_read", "rows_written")


def score_stream(df: DataFrame, model: PipelineModel | str, profile: str | Profile | None = None,
                 keep: Sequence[str] = (), text_col: str = "text") -> DataFrame:
    """Apply a (saved) sentiment pipeline to a stream of texts."""
    m = load_model(model) if isinstance(model, str) else model
    scored = score_texts(df, m, profile, text_col)
    return scored.select(*keep, text_col, "prediction")


# ------------------------------------------------------------------ the jobs

def routed_frame(df: DataFrame, routes: DataFrame, text_col: str = "text",
                 unicode: bool = False) -> DataFrame:
    """T7 transformation of a batch or micro-batch: route the raw text by
    keyword (P10/P11), publish the cleaned text (F3) as Kafka rows ``(key,
    value, topic)``, one row per input row and matching topic.  Needs the text
    alone; ``unicode`` matches keywords of any script."""
    routed = keyword_route(df, routes, id_col=None, text_col=text_col, keep=[text_col], unicode=unicode)
    return kafka_frame(routed.withColumn(text_col, clean_tweet(text_col)), topic="topic",
                       text_col=text_col)


def collect_to_kafka(df: DataFrame, routes: DataFrame, servers: str, checkpoint: str,
                     trigger: dict | None = None, unicode: bool = True) -> StreamingQuery:
    """Job 1, the collector: keyword-matched, cleaned texts of a stream are
    published to their topics by one query for all topics, micro-batch by
    micro-batch (at least once, as Spark's Kafka sink)."""
    require_kafka(df.sparkSession, servers)
    return (df.writeStream
            .foreachBatch(lambda batch, _: write_kafka(routed_frame(batch, routes, unicode=unicode), servers))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or PRODUCTION_TRIGGER)).start())


def scored_texts_to_table(texts: DataFrame, model: PipelineModel | str, path: str, checkpoint: str,
                          table: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Job 2 with a model: a stream of ``text`` scored and appended to a table
    as ``(text, prediction)`` exactly once."""
    return run_to_table(score_stream(texts, model), path, checkpoint, trigger or PRODUCTION_TRIGGER, table)


def kafka_to_scored_table(spark: SparkSession, servers: str, topic: str, model: PipelineModel | str, path: str,
                          checkpoint: str, table: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """A topic's payloads scored by a saved model and appended to a table."""
    return scored_texts_to_table(read_kafka_stream(spark, servers, topic), model, path, checkpoint, table, trigger)


def texts_to_table(texts: DataFrame, path: str, checkpoint: str, table: str | None = None,
                   trigger: dict | None = None) -> StreamingQuery:
    """Job 2 after the source: a stream of ``text`` shaped to ``(text, words,
    length)`` per micro-batch and appended to a table exactly once."""
    return run_to_table(texts, path, checkpoint, trigger or PRODUCTION_TRIGGER, table,
                        transform=lambda b: shape_stream(b, clean=False))


def kafka_to_table(spark: SparkSession, servers: str, topic: str, path: str, checkpoint: str,
                   table: str | None = None, trigger: dict | None = None,
                   min_partitions: int | None = None) -> StreamingQuery:
    """Job 2: a topic's payloads shaped to ``(text, words, length)`` and
    appended to a table every micro-batch (5 s by default), exactly once."""
    stream = read_kafka_stream(spark, servers, topic, min_partitions=min_partitions)
    return texts_to_table(stream, path, checkpoint, table, trigger)
