"""File and table scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

TEXT_SCHEMA = StructType([StructField("text", StringType(), True)])

# The Pashto corpora: header-less CSV, an id and the text.
CSV_SCHEMA = "col0 INT, col1 STRING"


#: Session setting with a number of partitions (unset: none) over which every
#: table read here is spread.  For inputs of one or two row groups, such as a
#: benchmark's, which Spark cannot split; it costs a shuffle of the columns read.
SPREAD_SETTING = "spark.chirpflow.scan.partitions"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    parts = spark.conf.get(SPREAD_SETTING, None)
    return df.repartition(int(parts)) if parts else df


def read_json_texts(spark: SparkSession, path: str, schema: StructType | str | None = TEXT_SCHEMA,
                    columns: Sequence[str] = ("text",), multi_line: bool = False) -> DataFrame:
    """JSON lines pruned to ``columns``.  A declared schema skips the
    inference pass over the whole input; ``schema=None`` infers it."""
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path).select(*columns)


def read_csv_texts(spark: SparkSession, path: str, schema: str = CSV_SCHEMA,
                   text_col: str = "col1", keep: Sequence[str] = (),
                   multi_line: bool = False) -> DataFrame:
    """S2 + P2: header-less CSV with a declared schema (PERMISSIVE: a bad field
    becomes NULL, the row stays), the text column renamed to ``text``.
    ``multi_line`` lets quoted fields hold newlines, but then Spark cannot split
    a file, so it is off unless asked for."""
    df = (spark.read.schema(schema).option("header", False)
          .option("multiLine", multi_line).csv(path))
    return df.selectExpr(*keep, f"`{text_col}` AS text")


#: Where a record that does not fit the declared schema is kept.
CORRUPT = "_corrupt_record"


def read_records(spark: SparkSession, path: str, schema: str, fmt: str = "json",
                 options: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """S1/S2 with malformed records: JSON lines or header-less CSV lines split into
    ``(good, rejected)``.

    ``good`` has the columns of ``schema``, all of whose values could be read;
    ``rejected`` the file and the line as it came, so nothing is lost and a repaired
    file can be read again.  A record is malformed if it is cut off, is no record at
    all, or has a value of another type or (CSV) another number of fields.  Lines are
    split before they are parsed, so any number of tasks reads one file; a record
    must not span lines.  Empty lines are no records."""
    lines = (spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
             .filter(F.trim("value") != ""))
    parse = {"json": F.from_json, "csv": F.from_csv}[fmt]
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **(options or {})}
    parsed = lines.withColumn("record", parse("value", f"{schema}, {CORRUPT} STRING", how))
    bad = F.col("record").isNull() | F.col(f"record.{CORRUPT}").isNotNull()
    return (parsed.filter(~bad).select("record.*").drop(CORRUPT),
            parsed.filter(bad).select("file", F.col("value").alias("line")))


def texts_frame(spark: SparkSession, texts: Sequence[str | None]) -> DataFrame:
    """Literal texts to a one-column frame with an explicit schema."""
    return spark.createDataFrame([(t,) for t in texts], TEXT_SCHEMA)
