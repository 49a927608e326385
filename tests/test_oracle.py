"""Every query with a SQL twin equals DuckDB on the same tables (sf0.001)."""

import os
import re
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, _rows  # noqa: E402

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_sql_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_rows_only_queries_are_the_iterative_or_random_ones():
    optional = {q for q in QUERIES if re.match(r"op\d+_|pipeline$", q)}  # the optional subpackage has its own tests
    assert set(QUERIES) - set(SQL) - optional == {
        "random_split", "lr_predictions", "lr_accuracy", "model_comparison", "score_texts", "whitespace_lr",
        "tree_accuracy"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql_twin(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _rows(cols, rows) == _rows(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "text", "words", "length"]
    assert df.count() == 200
