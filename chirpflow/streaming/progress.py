"""What a running query reports about its micro-batches (A2, T5)."""

from __future__ import annotations

import threading
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SEEN = "rows_seen"


def observe_rows(df: DataFrame, name: str = SEEN) -> DataFrame:
    """Count the rows that pass this place of a streaming plan, per micro-batch.
    For queries with a built-in sink; ``foreachBatch`` jobs count with
    ``run_to_table(counts=...)``, whose numbers survive a restart."""
    return df.observe(name, F.count(F.lit(1)).alias("n"))


class ProgressLog(StreamingQueryListener):
    """The latest ``keep`` micro-batches of all queries of a session: query id,
    batch id, rows read from the sources, and the counts of ``observe_rows``."""

    def __init__(self, keep: int = 1000):
        self._rows: deque = deque(maxlen=keep)
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {"query_id": str(p.id), "batch_id": p.batchId, "rows_read": p.numInputRows,
               **{name: values["n"] for name, values in p.observedMetrics.items()}}
        with self._lock:
            self._rows.append(row)

    def rows(self, query_id: str | None = None) -> list[dict]:
        with self._lock:
            return [r for r in self._rows if query_id in (None, r["query_id"])]


def log_progress(spark: SparkSession, keep: int = 1000) -> ProgressLog:
    """A ``ProgressLog`` that hears from all queries of the session from now on."""
    log = ProgressLog(keep)
    spark.streams.addListener(log)
    return log
