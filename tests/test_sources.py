"""File sources and sinks."""

import os

from pyspark.sql import Row

from chirpflow.session import local_fs_path, scratch_path
from chirpflow.sinks.kafka import kafka_frame
from chirpflow.sources.files import read_csv_texts, read_json_texts, read_records, texts_frame
from chirpflow.sources.kafka import payload_text


def _write(spark, name, content):
    path = local_fs_path(scratch_path(spark, "test-src", name))
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0"), "w", encoding="utf-8") as f:
        f.write(content)
    return path


def test_csv_permissive_nulls_bad_field_only(spark):
    path = _write(spark, "csv", "abc,bad\n4,\n5,\"multi\nline\"\n")
    rows = [tuple(r) for r in read_csv_texts(spark, path, keep=["col0"], multi_line=True).collect()]
    assert rows == [(None, "bad"), (4, None), (5, "multi\nline")]


def test_json_inferred_and_declared(spark):
    path = _write(spark, "json", '{"text": "a", "id": 1}\n{"text": "b", "extra": true}\n')
    assert [r.text for r in read_json_texts(spark, path).collect()] == ["a", "b"]
    assert [r.text for r in read_json_texts(spark, path, schema=None).collect()] == ["a", "b"]


def test_malformed_json_is_kept_apart(spark):
    lines = ['{"id": 1, "text": "a"}', '{"id": 2, "text": "cut', "", "   ", "no json", '{"id": "x", "text": "b"}',
             '{"text": "c"}', '{"id": 3, "text": null, "more": 1}', "[1, 2]", "7", '{"id": 4.5, "text": "d"}', "null"]
    path = _write(spark, "json-bad", "\n".join(lines) + "\n")
    good, rejected = read_records(spark, path, "id BIGINT, text STRING")
    assert sorted(map(str, good.collect())) == sorted(map(str, [Row(id=1, text="a"), Row(id=None, text="c"), Row(id=3, text=None)]))
    assert good.columns == ["id", "text"] and rejected.columns == ["file", "line"]
    bad = [r.line for r in rejected.collect()]
    assert sorted(bad) == sorted([lines[1], "no json", lines[5], "[1, 2]", "7", lines[10], "null"])
    assert good.count() + rejected.count() == 10 and good.select("text").distinct().count() == 3
    assert all(r.file.endswith("part-0") for r in rejected.collect())


def test_malformed_csv_is_kept_apart(spark):
    path = _write(spark, "csv-bad", '1,a\nx,b\n2,"quoted, comma"\n3\n4,c,d\n,e\n')
    good, rejected = read_records(spark, path, "id BIGINT, text STRING", "csv")
    assert sorted((str(r.id), r.text) for r in good.collect()) == [("1", "a"), ("2", "quoted, comma"), ("None", "e")]
    assert sorted(r.line for r in rejected.collect()) == ["3", "4,c,d", "x,b"]


def test_texts_frame_single_column(spark):
    df = texts_frame(spark, ["I hate you"])
    assert df.columns == ["text"] and df.first().text == "I hate you"


def test_kafka_frame_contract_roundtrip(spark):
    df = texts_frame(spark, ["héllo", None])
    frame = kafka_frame(df, topic="afghan_tweets")
    assert [f.name for f in frame.schema.fields] == ["key", "value", "topic"]
    back = [r.text for r in payload_text(frame).collect()]
    assert back == ["héllo", None]
    assert frame.filter("key IS NOT NULL").count() == 0


def test_schema_frame_lists_columns(spark):
    from chirpflow.operators.prepare import schema_frame
    df = texts_frame(spark, ["x"]).selectExpr("text", "length(text) AS n")
    assert [tuple(r) for r in schema_frame(df).collect()] == [("text", "string"), ("n", "int")]


def test_shuffle_rows_keeps_rows(spark):
    from chirpflow.operators.prepare import shuffle_rows
    df = spark.range(100)
    out = shuffle_rows(df, 7)
    assert sorted(r.id for r in out.collect()) == list(range(100))
    assert [r.id for r in out.collect()] == [r.id for r in shuffle_rows(df, 7).collect()]


def test_keyed_shuffle_is_the_same_for_every_layout(spark):
    from chirpflow.operators.prepare import shuffle_rows
    df = spark.range(500)
    orders = [[r.id for r in shuffle_rows(d, 7, key="id").collect()] for d in (df, df.repartition(5), df.repartition(2))]
    assert orders[0] == orders[1] == orders[2] != sorted(orders[0])
    assert [r.id for r in shuffle_rows(df, 8, key="id").collect()] != orders[0]
    placed = {r.position: r.id for r in shuffle_rows(df.repartition(3), 7, key="id", position="position").collect()}
    assert [placed[i] for i in range(1, 501)] == orders[0]
