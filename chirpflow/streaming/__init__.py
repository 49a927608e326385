"""Structured Streaming jobs."""

from .jobs import (  # noqa: F401
    batch_counts, read_text_stream, run_to_table, score_stream, shape_stream,
)
