"""chirpflow: text streams and TF-IDF sentiment models on Spark DataFrames,
Structured Streaming and MLlib."""

__version__ = "0.1.0"
