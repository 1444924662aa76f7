"""Every registered query against its SQL oracle, or against what else must hold."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

ROOT = os.environ.get("WAYMARK_TEST_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{ROOT}/{name}.parquet'")
    return connection


def plain_type(arrow_type) -> str:
    text = str(arrow_type)
    if text.startswith("timestamp"):
        return "timestamp"
    return {"large_string": "string"}.get(text, text)


def sorted_rows(table):
    names = sorted(table.column_names)
    rows = zip(*[table.column(n).to_pylist() for n in names], strict=True)
    return sorted(rows, key=repr)


# The training-corpus queries have their own tests.
QUERIES = sorted(set(contract.queries()) - set(getattr(contract.corpus_plans(), "QUERIES", ())))


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    table = contract.queries()[name](spark, ROOT).toArrow()
    assert table.num_rows > 0
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return
    expected = duck.execute(sql).to_arrow_table()
    types = lambda t: {f.name: plain_type(f.type) for f in t.schema}
    assert types(table) == types(expected)
    actual_rows, expected_rows = sorted_rows(table), sorted_rows(expected)
    assert len(actual_rows) == len(expected_rows)
    for actual, wanted in zip(actual_rows, expected_rows, strict=True):
        for a, w in zip(actual, wanted, strict=True):
            assert a == w or (isinstance(a, float) and math.isnan(a) and math.isnan(w))


def test_ordered_queries_keep_their_order(spark, duck):
    for name in ("sorted_projection", "sorted_projection_sql", "top_k_series", "group_count_desc"):
        rows = contract.queries()[name](spark, ROOT).toArrow().to_pylist()
        assert rows == duck.execute(contract.oracle_sql()[name]).to_arrow_table().to_pylist()


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [r.pickup_hour for r in rows] == list(range(24))
