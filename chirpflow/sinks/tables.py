"""Table sinks (K2, P9) and model save (K6).

Micro-batches are written idempotently: each batch goes to its own
``(query_id, batch_id)`` partition with dynamic partition overwrite, so a batch
replayed after a failure replaces its first attempt, while another query, or a
new checkpoint, never touches it.  Together with the query checkpoint this gives
exactly-once rows in the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .compaction import is_compacted


def append_to_table(df: DataFrame, table: str, path: str | None = None,
                    fmt: str = "parquet") -> None:
    """K2 for a batch frame: append to a catalog table (columns matched by
    name).  ``path`` makes it an external table in a shared folder."""
    w = df.write.mode("append").format(fmt)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def _write_partition(batch: DataFrame, batch_id: int, path: str, fmt: str, query_id: str) -> None:
    (batch.withColumns({"query_id": F.lit(query_id), "batch_id": F.lit(batch_id).cast("bigint")})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("query_id", "batch_id").format(fmt).save(path))


def append_batch(batch: DataFrame, batch_id: int, path: str, table: str | None = None,
                 fmt: str = "parquet", query_id: str = "",
                 transform: Callable[[DataFrame], DataFrame] | None = None,
                 counts: str | None = None) -> None:
    """K2 for one micro-batch (the ``foreachBatch`` body).  Skips empty
    batches (P9), overwrites only this query's partition for this batch, and
    registers that partition in an optional catalog table over the folder.  A
    batch that a compaction has taken into a segment is not written again.

    ``transform`` is a stateless per-batch step.  The emptiness check runs on
    the raw batch, before any text work.  With ``counts``, a folder, the rows
    read and the rows written (A2) go to a table there (``rows_per_batch``): both
    are observed while the batch is written, so nothing is read twice, and an
    empty batch or one whose rows the transform drops has its row too."""
    query_id = query_id or "none"
    spark = batch.sparkSession
    if is_compacted(spark, path, query_id, batch_id):
        return
    read = written = 0
    if not batch.isEmpty():
        if counts:
            came, went = Observation(), Observation()
            batch = batch.observe(came, F.count(F.lit(1)).alias("n"))
        if transform is not None:
            batch = transform(batch)
        if counts:
            batch = batch.observe(went, F.count(F.lit(1)).alias("n"))
        _write_partition(batch, batch_id, path, fmt, query_id)
        if counts:
            read, written = came.get["n"], went.get["n"]
        if table:
            if not spark.catalog.tableExists(table):
                spark.catalog.createTable(table, path=path, source=fmt)
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS "
                      f"PARTITION (query_id = '{query_id}', batch_id = {int(batch_id)})")
    if counts:
        row = spark.range(1).select(F.lit(read).cast("bigint").alias("rows_read"),
                                    F.lit(written).cast("bigint").alias("rows_written"))
        _write_partition(row.coalesce(1), batch_id, counts, fmt, query_id)


def save_model(model: PipelineModel, path: str) -> str:
    """K6: save a fitted pipeline, replacing what is there.  Its stages are all that
    scoring needs; the name of its preparation beside it is for information
    (``load_model`` brings it back)."""
    model.write().overwrite().save(path)
    profile = getattr(model, "profile", None)
    if profile is not None:
        spark = SparkSession.getActiveSession()
        spark.range(1).select(F.lit(profile.name).alias("value")).coalesce(1).write.text(f"{path}/profile")
    return path
