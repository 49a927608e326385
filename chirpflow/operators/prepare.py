"""Labelled-set preparation: projection, literals, union, counts, sort, split
(P1-P5, U1, A1, O1, O2, O4) and positions in an order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..session import scratch_path

POSITIVE, NEGATIVE = "Positive", "Negative"


def project(df: DataFrame, *cols: str | Column) -> DataFrame:
    """P1."""
    return df.select(*cols)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """``selectExpr("old as new")`` for every mapped column, others kept."""
    exprs = [f"`{c}` AS `{mapping[c]}`" if c in mapping else f"`{c}`" for c in df.columns]
    return df.selectExpr(*exprs)


def with_literal(df: DataFrame, name: str, value) -> DataFrame:
    """P5."""
    return df.withColumn(name, F.lit(value))


def class_frame(df: DataFrame, sentiment: str, label: int) -> DataFrame:
    """One class of the training set: literal ``sentiment`` and ``label`` columns."""
    return with_literal(with_literal(df, "sentiment", sentiment), "label", label)


def union_classes(*frames: DataFrame, by_name: bool = True) -> DataFrame:
    """UNION ALL of class frames, duplicates kept.  ``by_name=False`` is the
    positional ``union`` (takes the first frame's names)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f) if by_name else out.union(f)
    return out


def attach_labels(docs: DataFrame, labels: DataFrame, label_col: str = "quality",
                  id_col: str = "doc_id") -> DataFrame:
    """Join documents to their labels in one pass: ``label`` (1/0) and
    ``sentiment`` (Positive/Negative; NULL for any other label).  Spark picks the join strategy from
    measured sizes; both sides are read once."""
    lab = labels.select(id_col, F.col(label_col).cast("int").alias("label"))
    return (docs.join(lab, id_col)
            .withColumn("sentiment", F.when(F.col("label") == 1, F.lit(POSITIVE))
                        .when(F.col("label") == 0, F.lit(NEGATIVE))))


def known_labels(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows labelled 0 or 1; a NULL or any other label is no class to train on."""
    return df.filter(F.col(label_col).isin(0, 1))


def class_counts(df: DataFrame, cols: Sequence[str] = ("label", "sentiment")) -> DataFrame:
    """A1: rows per class in one aggregation (partial counts before the shuffle)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


#: ``monotonically_increasing_id`` holds the partition above this many bits.
_ROW_BITS = 33


def partition_bases(rows: DataFrame, at: str) -> DataFrame:
    """``(part, base)``: the rows in all partitions before each partition, from
    row numbers ``at`` made by ``monotonically_increasing_id``.  One row per
    partition, so the prefix sum and its broadcast are bounded by the number of
    partitions, not by the data."""
    totals = (rows.select(F.shiftright(at, _ROW_BITS).alias("part"))
              .groupBy("part").agg(F.count(F.lit(1)).alias("n")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def with_position(df: DataFrame, *order: str | Column, name: str = "position") -> DataFrame:
    """Every row with its place, from 1, in the global order by ``order``.

    A range-partitioned sort, a count per partition and a prefix sum over these
    counts; no task sees more than its range.  The input's row number is the last
    key, so the range partitioner can cut between rows that are equal in
    ``order``, however many they are.  The sorted rows are written once to the
    shared folder: a row's place stays what it is, whatever is computed again."""
    spark = df.sparkSession
    keys = [F.col(k) if isinstance(k, str) else k for k in order]
    ordered = (df.withColumn("_tie", F.monotonically_increasing_id()).orderBy(*keys, "_tie").drop("_tie")
               .withColumn("_at", F.monotonically_increasing_id()))
    path = scratch_path(spark, "positions")
    ordered.write.parquet(path)
    rows = spark.read.schema(ordered.schema).parquet(path)
    placed = rows.withColumn("part", F.shiftright("_at", _ROW_BITS)).join(
        F.broadcast(partition_bases(rows, "_at")), "part")
    inside = F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("base") + inside + 1).alias(name))


def label_sort(df: DataFrame, col: str = "label",
               tie_break: Sequence[str] = ("doc_id",), position: str | None = None) -> DataFrame:
    """O1: global ascending sort by label (range-partitioned shuffle).

    A label has two values, so range partitioning on it alone would put each
    class, half the data or more, into one partition.  The unique tie-break
    key lets the range partitioner cut inside a class; the order by label is
    unchanged (the order within a label is unspecified anyway).  With
    ``position`` each row carries its place in the order (``with_position``)."""
    keys = [F.col(col).asc(), *[F.col(k).asc() for k in tie_break if k in df.columns]]
    return with_position(df, *keys, name=position) if position else df.orderBy(*keys)


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] = ("doc_id",)) -> DataFrame:
    """O2: first ``n`` rows by a key (a deterministic ``show(n)``)."""
    return df.orderBy(*order_by).limit(n)


def split_bucket(key: Column | str) -> Column:
    """Stable bucket 0..99 from the md5 of a key (same value in DuckDB).  Rows
    without a key are in the last bucket, so every row has a side."""
    k = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.pmod(F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint"),
                             F.lit(100)), F.lit(99).cast("bigint"))


def hash_split(df: DataFrame, key: str = "doc_id",
               train_percent: int = C.TRAIN_PERCENT) -> tuple[DataFrame, DataFrame]:
    """O4, keyed mode: a row's side depends only on its key, never on the
    partition layout, so the split is reproducible at any scale."""
    b = split_bucket(key)
    return df.filter(b < train_percent), df.filter(b >= train_percent)


def random_split(df: DataFrame, train_percent: int = C.TRAIN_PERCENT,
                 seed: int = C.RANDOM_SPLIT_SEED,
                 sort_first: str | None = None) -> tuple[DataFrame, DataFrame]:
    """O4, faithful mode: ``randomSplit`` (stable only for one partition
    layout).  ``sort_first="label"`` sorts by that column first (O1), as the
    training scripts do, which is what fixes the layout ``randomSplit`` sees."""
    if sort_first:
        df = label_sort(df, sort_first)
    frac = train_percent / 100.0
    train, test = df.randomSplit([frac, 1.0 - frac], seed=seed)
    return train, test


def with_split_side(df: DataFrame, key: str = "doc_id",
                    train_percent: int = C.TRAIN_PERCENT) -> DataFrame:
    """Tag rows with ``side`` = train/test instead of producing two frames."""
    return df.withColumn("side", F.when(split_bucket(key) < train_percent, F.lit("train"))
                         .otherwise(F.lit("test")))


def index_labels(df: DataFrame, input_col: str = "sentiment", output_col: str = "label"):
    """Learn the label from a class-name column with ``StringIndexer``.
    The most frequent name gets 0.0, so the meaning of 0/1 follows the data
    (unlike the literal labels of ``class_frame``).  Returns the fitted
    indexer and the indexed frame."""
    model = StringIndexer(inputCol=input_col, outputCol=output_col,
                          stringOrderType="frequencyDesc").fit(df)
    return model, model.transform(df)


def shuffle_rows(df: DataFrame, seed: int = C.RANDOM_SPLIT_SEED, key: str | None = None,
                 position: str | None = None) -> DataFrame:
    """Random global order (a range-partitioned sort).  The order comes from
    a seeded random key or, with ``key``, from the md5 of seed and key, which is
    the same whatever the layout of the input.  With ``position`` each row
    carries its place (``with_position``)."""
    order = [F.rand(seed)] if key is None else [
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))), F.col(key)]
    return with_position(df, *order, name=position) if position else df.orderBy(*order)


def schema_frame(df: DataFrame) -> DataFrame:
    """K4/K5: the column names and types of a frame as rows ``(column, type)``
    (built from schema metadata, not from the data)."""
    return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")
