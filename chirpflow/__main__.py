"""Command-line entry points for the three jobs.

    python -m chirpflow train   --positive P --negative N [--format json|csv|parquet]
                                [--profile english|whitespace] [--classifiers lr nb ...] --model-dir DIR
    python -m chirpflow score   --model DIR --input PATH [--format ...] --output PATH
    python -m chirpflow stream  --servers HOST:PORT --topic T --table-path PATH --checkpoint PATH
                                [--table NAME] [--model DIR]
    python -m chirpflow collect --servers HOST:PORT --input PATH --routes routes.json --checkpoint PATH
                                [--ascii]

``routes.json`` maps each topic to its keywords: ``{"topic": ["kw", ...]}``.
Scoring prepares texts as the saved model says.  ``stream --model`` writes
``(text, prediction)`` instead of ``(text, words, length)``.  ``collect`` needs a
``text`` column only; ``--ascii`` matches keywords on ASCII words.
Cluster settings (master, ``spark.checkpoint.dir``, ...) come from
``spark-submit`` / ``spark-defaults.conf``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from .operators import filters as FL
from .operators import models as M
from .operators.features import get_profile
from .session import clear_scratch, get_session, input_bytes, tune_shuffle
from .sources.files import read_csv_texts, read_json_texts
from .sources.models import load_model
from .streaming import jobs as S


def _read(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "json":
        return read_json_texts(spark, path)
    if fmt == "csv":
        return read_csv_texts(spark, path)
    return spark.read.parquet(path)


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="chirpflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    fmt = {"choices": ["json", "csv", "parquet"], "default": "json"}
    prof = {"choices": ["english", "whitespace"], "default": "english"}

    t = sub.add_parser("train", help="fit LR and NB on two class corpora, save both")
    t.add_argument("--positive", required=True)
    t.add_argument("--negative", required=True)
    t.add_argument("--format", **fmt)
    t.add_argument("--profile", **prof)
    t.add_argument("--classifiers", nargs="+", choices=["lr", "nb", "rf", "dt", "gbt"], default=["lr", "nb"])
    t.add_argument("--model-dir", required=True)

    s = sub.add_parser("score", help="apply a saved model to texts")
    s.add_argument("--model", required=True)
    s.add_argument("--input", required=True)
    s.add_argument("--format", **fmt)
    s.add_argument("--output", required=True)

    st = sub.add_parser("stream", help="Kafka topic -> (text, words, length) table")
    st.add_argument("--servers", required=True)
    st.add_argument("--topic", required=True)
    st.add_argument("--table-path", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--table")
    st.add_argument("--model")

    c = sub.add_parser("collect", help="route and publish a text stream to Kafka topics")
    c.add_argument("--servers", required=True)
    c.add_argument("--input", required=True)
    c.add_argument("--routes", required=True)
    c.add_argument("--checkpoint", required=True)
    c.add_argument("--ascii", action="store_true")
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    own = spark is None
    spark = spark or get_session()
    try:
        _run(args, spark)
    finally:
        if own:  # a session of the caller's may have scratch data in use
            clear_scratch(spark)
    return 0


def _run(args: argparse.Namespace, spark: SparkSession) -> None:
    if args.cmd == "train":
        pos = _read(spark, args.positive, args.format)
        neg = _read(spark, args.negative, args.format)
        tune_shuffle(spark, input_bytes(pos) + input_bytes(neg))
        _, comparison = M.train_sentiment(pos, neg, get_profile(args.profile), key="text",
                                          names=args.classifiers, model_dir=args.model_dir)
        for r in comparison.collect():
            print(f"{r.model}\t{r.metric}\t{r.value:.6f}")
    elif args.cmd == "score":
        texts = _read(spark, args.input, args.format)
        tune_shuffle(spark, input_bytes(texts))
        scored = M.score_texts(texts, load_model(args.model))
        scored.select("text", "prediction").write.mode("overwrite").parquet(args.output)
    elif args.cmd == "stream":
        if args.model:
            query = S.kafka_to_scored_table(spark, args.servers, args.topic, args.model, args.table_path,
                                            args.checkpoint, table=args.table)
        else:
            query = S.kafka_to_table(spark, args.servers, args.topic, args.table_path, args.checkpoint,
                                     table=args.table)
        query.awaitTermination()
    elif args.cmd == "collect":
        with open(args.routes, encoding="utf-8") as f:
            routes = FL.routes_frame(spark, list(json.load(f).items()))
        source = spark.readStream.schema(spark.read.parquet(args.input).schema).parquet(args.input)
        S.collect_to_kafka(source, routes, args.servers, args.checkpoint,
                           unicode=not args.ascii).awaitTermination()


if __name__ == "__main__":
    sys.exit(main())
