"""Scans: Parquet tables, JSON/CSV text corpora, Kafka, saved models."""

from .files import read_csv_texts, read_json_texts, read_table, texts_frame  # noqa: F401
from .kafka import read_kafka_stream, read_kafka  # noqa: F401
from .models import load_model  # noqa: F401
