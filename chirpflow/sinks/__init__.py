"""Sinks: Kafka frame and writer, table append, model save."""

from .kafka import kafka_frame, write_kafka, write_kafka_stream  # noqa: F401
from .tables import append_batch, append_to_table, save_model  # noqa: F401
